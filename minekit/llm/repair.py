"""Repair of a conversation's structure by scalar big-integer weights.

Rows of a conversation, in order, become a conversation whose role initials
read ``(s?(ua)+)?`` by the cheapest edits: Keep (0), Rerole to user or assistant
(3), Delete (4, required for blank and duplicate rows), Insert an empty user or
assistant turn (3); a truncated row that is not deleted adds 3.  Of equally
cheap repairs the one with the ASCII-least string of edit initials is chosen.

A repair is a path through the nodes (rows consumed, what the last turn is).
Its weight is one integer: the cost in the high digits, and below it a digit
per edit at fixed places, D < I < K < R as 1 to 4, with zeros after the end.
The least integer at every node decides cost and ties at once.  Comparing
paths of different lengths is right: of two with the same rows and the same
cost neither edit string begins the other, as what is left over would be
inserts, which cost.

The width of the digits is bounded by taking ``BLOCK`` rows at a time.  At the
end of a block, right after a row, no edit string of a live path begins
another's, so the order of the strings so far is all that later ties need: one
digit keeps it.  Paths that cost ``HOPELESS`` more than the best are dropped, since
the best can take over any other's rest for less.  What all live paths agree
on is put out and its texts are let go, so a conversation of any length needs
little memory and time in proportion to its rows.

Rows are ordered by turn (nulls first), and within a turn by role and text.  A
row's faults: blank (no character but space, tab, line feed to carriage
return), duplicate (role and text seen earlier), truncated (the last other
character is none of ``.!?``); the first one counts.

Defined cases: a null role or text is one space; a role without an initial u, a
or s cannot be kept; a null conversation id is a conversation like any other;
null turns are ignored in the gaps; a conversation without rows left is all
zeros; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minekit.llm.frames import release_memory

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows after which the digits begin anew.
BLOCK = 32
#: A path this much dearer than the best cannot win: two inserts and a deletion make up any difference.
HOPELESS = 2 * INSERT + DELETE + TRUNCATED

_DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = " DIKR"
_BITS, _ROOM = 3, 3 * BLOCK + 2            # bits of a digit, digits of a block (two inserts before each row and at the end)
_RANK = _BITS * _ROOM
_COST = _RANK + 4

#: The nodes of a row: what stands last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What may follow: a user after all but a user, an assistant after a user, a system turn first.
_BEFORE = {USER: (NOTHING, SYSTEM, ASSISTANT), ASSISTANT: (USER,), SYSTEM: (NOTHING,)}
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_FLOWS = {"su", "ua", "au"}

Path = tuple[int, int]                     # weight, digits used


def _add(path: Path, letter: str, cost: int) -> Path:
    weight, used = path
    return weight + (cost << _COST) + (_DIGIT[letter] << _BITS * (_ROOM - 1 - used)), used + 1


def _offer(paths: dict[int, Path], node: int, path: Path) -> None:
    if node not in paths or path < paths[node]:
        paths[node] = path


def _inserts(paths: dict[int, Path]) -> dict[int, Path]:
    """Every path, and what it becomes by up to two inserts (a third would pass a node again)."""
    out = dict(paths)
    for _ in range(2):
        for node, befores in ((USER, _BEFORE[USER]), (ASSISTANT, _BEFORE[ASSISTANT])):
            for before in befores:
                if before in out:
                    _offer(out, node, _add(out[before], "I", INSERT))
    return out


def _row(paths: dict[int, Path], initial: int | None, must_go: bool, truncated: bool) -> dict[int, Path]:
    """The least paths after one more row."""
    paths, out = _inserts(paths), {}
    more = TRUNCATED if truncated else 0
    for node, path in paths.items():
        _offer(out, node, _add(path, "D", DELETE))
    if not must_go:
        for node, befores in _BEFORE.items():
            for before in befores:
                if before in paths:
                    if node == initial:
                        _offer(out, node, _add(paths[before], "K", KEEP + more))
                    elif node != SYSTEM:
                        _offer(out, node, _add(paths[before], "R", REROLE + more))
    return out


def _letters(path: Path) -> str:
    return "".join(_LETTER[path[0] >> _BITS * (_ROOM - 1 - i) & 7] for i in range(path[1]))


class Conversation:
    """One conversation, row by row."""

    def __init__(self):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns: list[int] = []                         # least, greatest, and how many different ones
        self.last: str | None = None
        self.paths: dict[int, Path] = {NOTHING: (0, 0)}
        self.in_block = 0
        self.base = 0                                      # cost of what the ranks stand for
        self.behind: dict[int, list[str]] = {0: []}        # rank: the edit strings of the blocks not put out yet
        self.waiting: list[list[tuple[str, str]]] = [[]]   # rows of those blocks and of this one
        self.edits: list[str] = []
        self.state, self.sha, self.started = NOTHING, hashlib.sha256(), False

    def add(self, turn: int | None, role: str, text: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        self.rows += 1
        duplicate, truncated = duplicate and not blank, truncated and not blank and not duplicate
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.rows > 1:
            self.illegal += self.last + role[:1] not in _FLOWS
        self.last = role[:1]
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        self.paths = _row(self.paths, _INITIAL.get(role[:1]), blank or duplicate, truncated)
        self.waiting[-1].append((role, text))
        self.in_block += 1
        if self.in_block == BLOCK:
            self._end_block()

    def _end_block(self) -> None:
        best = min(w >> _COST for w, _ in self.paths.values())
        live = {n: p for n, p in self.paths.items() if (p[0] >> _COST) - best <= HOPELESS}
        order = sorted(live, key=lambda n: live[n][0] & (1 << _COST) - 1)          # by the strings alone
        behind, paths = {}, {}
        for rank, node in enumerate(order):
            weight = live[node][0]
            behind[rank] = [*self.behind[weight >> _RANK & 15], _letters(live[node])]
            paths[node] = ((weight >> _COST) - best << _COST) + (rank << _RANK), 0
        self.paths, self.behind, self.base, self.in_block = paths, behind, self.base + best, 0
        self.waiting.append([])
        first = next(iter(behind.values()))
        agreed = 0
        while agreed < len(first) and all(b[agreed] == first[agreed] for b in behind.values()):
            agreed += 1
        self._put_out(first[:agreed])
        for blocks in behind.values():
            del blocks[:agreed]

    def _put_out(self, blocks: list[str]) -> None:
        """Applies decided edits to the rows that wait."""
        for letters in blocks:
            rows = iter(self.waiting.pop(0))
            for letter in letters:
                role, text = ("", "") if letter == "I" else next(rows)
                if letter == "D":
                    continue
                if letter == "K":
                    self.state = _INITIAL[role[:1]]
                else:
                    self.state = ASSISTANT if self.state == USER else USER
                    role = _ROLE[self.state]
                self.sha.update(f"{chr(10) if self.started else ''}{role}:{text}".encode())
                self.started = True
            self.edits.append(letters)

    def end(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        if not self.rows:
            return 0, 0, 0, 0, 0, 0, "", self.sha.hexdigest()
        weight, used = min(p for n, p in _inserts(self.paths).items() if n in (NOTHING, ASSISTANT))
        self._put_out([*self.behind[weight >> _RANK & 15], _letters((weight, used))])
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.base + (weight >> _COST),
                "".join(self.edits), self.sha.hexdigest())


_RESULT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
           ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]

_NOT_BLANK = r"[^\x20\x09-\x0D]"


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` from rows
    ``conv_id, turn, role, text``; a row with a true ``gone`` only says that its conversation exists."""
    if "gone" not in rows.columns:
        rows = rows.withColumn("gone", F.lit(False))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "gone")
    # earlier rows of a role and text: by turn; rows of one turn that agree in both are alike
    earlier = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("again", F.row_number().over(earlier) > 1)
    rows = rows.withColumn("blank", ~F.col("text").rlike(_NOT_BLANK)).withColumn(
        "cut", ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"))
    order = ["conv_id", "gone", F.col("turn").asc_nulls_first(), "role", "text", "again"]
    rows = rows.select("conv_id", "turn", "role", "text", "gone", "blank", "again", "cut")
    dealt = rows.repartition("conv_id").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, results = [], []
        last, current = None, None

        def out() -> pa.RecordBatch:
            cols = [pa.array(ids, pa.int64())] + [pa.array([r[i] for r in results], t) for i, (_, t) in enumerate(_RESULT)]
            return pa.RecordBatch.from_arrays(cols, names=["conv_id", *(n for n, _ in _RESULT)])

        for batch in batches:
            for conv, turn, role, text, gone, *faults in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or conv != last:
                    if current is not None:
                        ids.append(last)
                        results.append(current.end())
                    last, current = conv, Conversation()
                if not gone:
                    current.add(turn, role, text, *faults)
            if ids:
                yield out()
                ids, results = [], []
        if current is not None:
            ids.append(last)
            results.append(current.end())
            yield out()
        release_memory()

    schema = "conv_id long, " + ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in _RESULT)
    return dealt.mapInArrow(run, schema)


def damage(turns: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text, gone`` with planted faults, chosen by the checksum of
    ``conv_id:turn`` (a null is one space) modulo 20: 0 drops the row, 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 makes its role user."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"))
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                       F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    rows = rows.withColumn("kind", kind)
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"), (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
