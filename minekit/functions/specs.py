"""Job specs as a column: base64 text -> JSON -> typed struct.

The reference decodes one spec per job on the driver.  Here decoding is an
expression, so a table of specs (one per row) decodes in parallel and
feeds whatever needs it.  ``operational_param`` is a ``map<string,string>``
so numbers arrive the same whether written as ``0.1`` or ``"0.1"``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TABLE = "map<string,string>"
SPEC_SCHEMA = (f"datasource struct<train_table: {TABLE}, test_table: {TABLE}>, "
               f"output struct<result_table: {TABLE}>, operational_param {TABLE}")


def decode_spec(encoded: Column) -> Column:
    """base64 JSON spec -> struct(datasource, output, operational_param).

    Text that is not base64 raises (ANSI ``unbase64``), and so does JSON that
    does not parse.  A NULL spec stays NULL, which ``require_spec`` turns into
    an error.
    """
    return F.from_json(F.unbase64(encoded).cast("string"), SPEC_SCHEMA, {"mode": "FAILFAST"})


def require_spec(spec: Column) -> Column:
    return F.when(spec.isNull(), F.raise_error(F.lit("job spec is not valid JSON"))).otherwise(spec)


def encode_spec(json_text: Column) -> Column:
    return F.base64(F.encode(json_text, "UTF-8"))


def param(spec: Column, *keys: str) -> Column:
    """First present key of ``operational_param`` (accepts spelling variants)."""
    vals = [F.try_element_at(spec.getField("operational_param"), F.lit(k)) for k in keys]
    return vals[0] if len(vals) == 1 else F.coalesce(*vals)
