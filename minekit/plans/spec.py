"""Job specs: the public API of every composite job.

A spec is the reference's JSON document, given as a dict, a JSON string or
base64 of one:

    {"datasource": {"train_table": {...}, "test_table": {...}},
     "output": {"result_table": {...}},
     "operational_param": {"train_label_col": "y",
                           "train_feture_col": "a b c", ...}}

Table entries are source / sink dicts (``minekit.sources.tables``).  Column
lists are one string split on single spaces.  Keys spelt ``feture`` and
``feature`` are both accepted; numbers may be JSON numbers or strings.
Passwords are never printed: ``repr`` masks them.
"""

from __future__ import annotations

import base64
import binascii
import json
from dataclasses import dataclass, field
from typing import Any

SECRET_KEYS = {"password", "account", "user"}


def _masked(d: dict | None) -> dict | None:
    if d is None:
        return None
    return {k: ("***" if k in SECRET_KEYS else v) for k, v in d.items()}


@dataclass
class JobSpec:
    train_table: dict | None
    test_table: dict | None
    result_table: dict | None
    params: dict[str, Any] = field(default_factory=dict)
    rules_table: dict | None = None

    # ------------------------------------------------------------ parsing
    @classmethod
    def parse(cls, spec: "JobSpec | dict | str | bytes") -> "JobSpec":
        if isinstance(spec, JobSpec):
            return spec
        if isinstance(spec, (str, bytes)):
            spec = _decode(spec)
        if not isinstance(spec, dict):
            raise ValueError("job spec must be a JSON object")
        ds = spec.get("datasource") or {}
        out = spec.get("output") or {}
        return cls(ds.get("train_table"), ds.get("test_table"), out.get("result_table"),
                   dict(spec.get("operational_param") or {}), out.get("rules_table"))

    def __repr__(self) -> str:
        return (f"JobSpec(train_table={_masked(self.train_table)}, test_table={_masked(self.test_table)}, "
                f"result_table={_masked(self.result_table)}, params={self.params})")

    # ---------------------------------------------------------- accessors
    def _raw(self, key: str, required: bool = True):
        variants = [key, key.replace("feture", "feature"), key.replace("feature", "feture")]
        for k in variants:
            if k in self.params and self.params[k] is not None:
                return self.params[k]
        if required:
            raise ValueError(f"job spec lacks operational_param.{key}")
        return None

    def text(self, key: str, default: str | None = None) -> str:
        v = self._raw(key, default is None)
        return str(v) if v is not None else default

    def columns(self, key: str, required: bool = True) -> list[str] | None:
        """A space-separated column list (split on single spaces, as given)."""
        v = self._raw(key, required)
        if v is None:
            return None
        cols = str(v).split(" ")
        while len(cols) > 1 and cols[-1] == "":      # Java's split drops trailing empties
            cols.pop()
        if any(c == "" for c in cols):
            raise ValueError(f"empty column name in operational_param.{key}: {v!r}")
        return cols

    def number(self, key: str, default: float | None = None) -> float:
        v = self._raw(key, default is None)
        return float(str(v)) if v is not None else float(default)

    def integer(self, key: str, default: int | None = None) -> int:
        v = self._raw(key, default is None)
        if v is None:
            return int(default)
        s = str(v).strip()
        try:
            return int(s)
        except ValueError:
            raise ValueError(f"operational_param.{key} is not an integer: {v!r}") from None

    def table(self, which: str) -> dict:
        t = getattr(self, which)
        if not t:
            raise ValueError(f"job spec lacks {which}")
        return t


def _decode(spec: str | bytes) -> dict:
    text = spec.decode() if isinstance(spec, bytes) else spec
    text = text.strip()
    if not text.startswith("{"):
        try:
            text = base64.b64decode(text, validate=True).decode("utf-8")
        except (binascii.Error, UnicodeDecodeError) as exc:
            raise ValueError("job spec is neither JSON nor base64 JSON") from exc
    return json.loads(text)


def encode(spec: dict) -> str:
    """base64 of the JSON text, as the reference's jobs receive it."""
    return base64.b64encode(json.dumps(spec).encode("utf-8")).decode("ascii")
