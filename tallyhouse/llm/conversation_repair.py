"""Cheapest repair of conversations by Four-Russians block tables.

A repaired conversation reads `(s?(ua)+)?` in the initials of its roles: nothing, or turns of user and assistant after at
most one system row.  Edits: Keep a row (0), Rerole it to user or assistant (3), Delete it (4), Insert an empty row (3); a row
that stays and is truncated adds 3; blank rows and duplicates must go.  Among the cheapest repairs the one whose edit
initials are least in ASCII counts.

**Tables.**  The costs of repairing what follows a row, one for each of the four states of the pattern, differ by at most 6, so the
vectors of these costs less their least are few.  They are numbered, and for every block of `LENGTH` symbols (role class
and truncation) two tables are computed: vector after the block → vector before it and the cost that it adds, and vector after
the block and state before it → state after it.  Rows that must go add 4 to all four costs and change no vector, so they are
counted beside the symbols.

**Processing.**  A conversation's blocks are looked up from the last to the first, which leaves the vector at every block's
end.  A block is then expanded backward from that vector, symbol by symbol, and read forward from its state: at each
place the least initial whose cost is tight is taken.  All ties are tight, so the result is the least of all cheapest repairs.
Expanded blocks are remembered by (vector, block, state).

**Spark.**  Equal rows are counted before anything else, and duplicates are found by the smallest turn of a role and text.
The rows are then sorted into ranges, so a long conversation is cut over many tasks.  Conversations that lie in one range are
repaired there; of the others each segment gives back its tables' result for every vector (a few hundred numbers), these are
joined by conversation, and the segments are expanded with the vector and state that they got.  The hash of a repaired
conversation is a chain, so the repaired texts of one cut conversation pass one task, as a stream of segments.

Edge cases: a null role or text is one space; null turns come first; rows of one turn are in order of role and text; a null
conversation is one of its own; a row with `times` 0 only names its conversation, which gets zeros and an empty repair if it has no
other; repeated rows are duplicates; an empty table gives an empty table; other input columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyhouse.llm.texts import whole
from tallyhouse.sources.scratch import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of the pattern: nothing yet, after s, after u, after a.  A row put in or reroled leads to NEXT.
NEXT = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
#: State after keeping a row: by state and role class (0 s, 1 u, 2 a, 3 other).
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}
SYMBOLS = 8  # role class * 2 + truncated
LENGTH = 4

Vector = tuple[int, int, int, int]


def _closed(costs: list[int]) -> list[int]:
    """Costs by state if rows may be put in first."""
    for state in (2, 3, 2, 0, 1):
        costs[state] = min(costs[state], INSERT + costs[NEXT[state]])
    return costs


def _before(after: Vector, symbol: int) -> list[int]:
    """Costs by state before a symbol, from those after it."""
    role, extra = symbol >> 1, TRUNCATED * (symbol & 1)
    costs = []
    for state in range(4):
        best = min(DELETE + after[state], REROLE + extra + after[NEXT[state]])
        if (state, role) in KEPT:
            best = min(best, KEEP + extra + after[KEPT[state, role]])
        costs.append(best)
    return _closed(costs)


class Tables:
    """Numbered vectors, and what symbols and blocks make of them."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.end = 0
        self.vectors: list[Vector] = [tuple(_closed([0, 99, 99, 0]))]  # the pattern may end in states 0 and 3
        numbers = {self.vectors[0]: 0}
        back, cost = [], []
        for vector in self.vectors:  # grows while new vectors turn up
            row, added = [], []
            for symbol in range(SYMBOLS):
                costs = _before(vector, symbol)
                found = tuple(c - min(costs) for c in costs)
                if found not in numbers:
                    numbers[found] = len(self.vectors)
                    self.vectors.append(found)
                row.append(numbers[found])
                added.append(min(costs))
            back.append(row)
            cost.append(added)
        n = len(self.vectors)
        self.back, self.cost = np.asarray(back), np.asarray(cost)
        self.step = np.asarray([[[self.read(v, s, q)[1] for q in range(4)] for s in range(SYMBOLS)] for v in range(n)])
        # Blocks: symbols in order, the first one in the highest digit.
        self.block_back, self.block_cost = self.back, self.cost
        self.block_step = self.step
        every = np.arange(n)
        for size in range(2, length + 1):
            first, rest = np.divmod(np.arange(SYMBOLS**size), SYMBOLS ** (size - 1))
            middle, added = self.block_back[:, rest], self.block_cost[:, rest]
            self.block_back = self.back[middle, first]
            self.block_cost = added + self.cost[middle, first]
            state = self.step[middle, first]
            self.block_step = self.block_step[every[:, None, None], rest[None, :, None], state]
        self._read: dict[tuple[int, int, int], tuple[str, int]] = {}

    def read(self, vector: int, symbol: int, state: int) -> tuple[str, int]:
        """Least initials of the tight edits up to and with a symbol's row, and the state after it."""
        after = self.vectors[vector]
        before = _before(after, symbol)
        role, extra, initials = symbol >> 1, TRUNCATED * (symbol & 1), ""
        while True:
            here = before[state]
            if here == DELETE + after[state]:
                return initials + "D", state
            if here == INSERT + before[NEXT[state]]:
                initials, state = initials + "I", NEXT[state]
            elif (state, role) in KEPT and here == KEEP + extra + after[KEPT[state, role]]:
                return initials + "K", KEPT[state, role]
            else:
                return initials + "R", NEXT[state]

    def finish(self, state: int) -> str:
        """Edits after the last row."""
        return {0: "", 1: "II", 2: "I", 3: ""}[state]

    def blocks(self, symbols: bytes) -> tuple[list[int], bytes]:
        """Numbers of the full blocks, and the symbols after them."""
        full = len(symbols) // self.length * self.length
        digits = np.frombuffer(symbols[:full], np.uint8).reshape(-1, self.length).astype(np.int64)
        return (digits @ (SYMBOLS ** np.arange(self.length - 1, -1, -1))).tolist(), symbols[full:]

    def vectors_after(self, symbols: bytes, exit: int) -> tuple[list[int], int, int]:
        """The vector after every full block and after the last of them, the vector before all, the cost added."""
        numbers, rest = self.blocks(symbols)
        vector, cost = exit, 0
        for symbol in reversed(rest):
            cost += int(self.cost[vector, symbol])
            vector = int(self.back[vector, symbol])
        after = []
        for block in reversed(numbers):
            after.append(vector)
            cost += int(self.block_cost[vector, block])
            vector = int(self.block_back[vector, block])
        return after[::-1], vector, cost

    def expand(self, vector: int, symbols: bytes, state: int) -> tuple[list[str], int]:
        """Edits of each symbol of a short run whose end has a vector, and the state after it."""
        inside = [vector]
        for symbol in reversed(symbols[1:]):
            inside.append(int(self.back[inside[-1], symbol]))
        edits = []
        for symbol, after in zip(symbols, reversed(inside), strict=True):
            initials, state = self.read(after, symbol, state)
            edits.append(initials)
        return edits, state

    def trace(self, symbols: bytes, exit: int, state: int) -> tuple[list[str], int]:
        """Edits of each symbol of a run of any length, and the state after it."""
        after, _, _ = self.vectors_after(symbols, exit)
        edits: list[str] = []
        for number, vector in enumerate(after):
            block = symbols[number * self.length : (number + 1) * self.length]
            known = (vector, block, state)
            if known not in self._read:
                self._read[known] = self.expand(vector, block, state)
            found, state = self._read[known]
            edits += found
        if rest := symbols[len(after) * self.length :]:
            found, state = self.expand(exit, rest, state)
            edits += found
        return edits, state

    def summary(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every vector after a run: the vector before it, the cost added, and state before → state after."""
        numbers, rest = self.blocks(symbols)
        vector, cost = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        taken = []
        for symbol in reversed(rest):
            taken.append((self.step, symbol, vector))
            cost, vector = cost + self.cost[vector, symbol], self.back[vector, symbol]
        for block in reversed(numbers):
            taken.append((self.block_step, block, vector))
            cost, vector = cost + self.block_cost[vector, block], self.block_back[vector, block]
        states = np.tile(np.arange(4), (len(self.vectors), 1))
        for steps, symbol, after in reversed(taken):
            states = steps[after[:, None], symbol, states]
        return vector, cost, states


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


# --- segments ---------------------------------------------------------------------------------------------------


class Segment:
    """Consecutive rows of a conversation: symbols of rows that may stay, counts of rows that go, texts."""

    def __init__(self) -> None:
        self.symbols, self.deletes, self.roles, self.texts = bytearray(), [0], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = self.turns = self.bytes = 0
        self.low = self.high = None
        self.first = self.last = ""

    def add(self, turn: int | None, role: str, text: str, times: int, blank: bool, first: bool, ended: bool) -> None:
        if not times:
            return
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        if not self.rows:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += times - 1
        self.last = initial
        self.rows += times
        stays = 0 if blank or not first else 1
        if blank:
            self.blank += times
        else:
            self.duplicate += times - stays
        if stays:
            self.symbols.append(2 * "sua".find(initial) + (not ended) if initial in ("s", "u", "a") else 6 + (not ended))
            self.truncated += not ended
            self.deletes.append(0)
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += len(text)
        self.deletes[-1] += times - stays

    def repaired(self, exit: int, state: int, is_last: bool) -> tuple[str, list[str]]:
        """Initials of the edits, and the rows of the repair as `role:text`."""
        book = tables()
        edits, after = book.trace(bytes(self.symbols), exit, state)
        audit, rows = ["D" * self.deletes[0]], []
        for initials, deletes, role, text in zip(edits, self.deletes[1:], self.roles, self.texts, strict=True):
            audit += [initials, "D" * deletes]
            for edit in initials:
                if edit == "D":
                    continue
                if edit == "K":
                    state = KEPT[state, "sua".find(role[:1])]
                    rows.append(f"{role}:{text}")
                else:
                    state = NEXT[state]
                    rows.append(f"{ROLES[state]}:{text if edit == 'R' else ''}")
        if is_last:
            audit.append(book.finish(after))
            for _ in audit[-1]:
                state = NEXT[state]
                rows.append(f"{ROLES[state]}:")
        return "".join(audit), rows

    @cached_property
    def gone(self) -> int:
        return DELETE * sum(self.deletes)


_COUNTS = ["rows", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high"]
_WHOLE = "cost long, audit string, sha string"
_OPEN = (
    "place long, gone long, first string, last string, back array<int>, added array<long>, steps array<int>, "
    "symbols binary, deletes array<long>, roles array<string>, texts array<string>"
)
_SEGMENT = f"conv string, named boolean, open boolean, {', '.join(f'{c} long' for c in _COUNTS)}, {_WHOLE}, {_OPEN}"


def _segments(batches: Iterator[pa.RecordBatch], rows_each: int, chars_each: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range → repaired conversations, and open segments of those that other ranges may hold too."""
    book, place = tables(), TaskContext.get().partitionId() << 32
    waiting: list[dict] = []

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for few in range(0, batch.num_rows, 1024):
                yield from zip(*(column.to_pylist() for column in batch.slice(few, 1024).columns), strict=True)

    def counted(segment: Segment, named: bool, conv: str) -> dict:
        return {"conv": conv, "named": named, **{name: getattr(segment, name) for name in _COUNTS}}

    def opened(segment: Segment, named: bool, conv: str) -> dict:
        nonlocal place
        place += 1
        back, added, steps = book.summary(bytes(segment.symbols))
        found = counted(segment, named, conv) | {"open": True, "place": place, "gone": segment.gone}
        found |= {"first": segment.first, "last": segment.last, "back": back, "added": added, "steps": steps.reshape(-1)}
        return found | {"symbols": bytes(segment.symbols), "deletes": segment.deletes, "roles": segment.roles, "texts": segment.texts}

    def closed(segment: Segment, named: bool, conv: str) -> dict:
        _, vector, cost = book.vectors_after(bytes(segment.symbols), book.end)
        audit, kept = segment.repaired(book.end, 0, True)
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        cost += book.vectors[vector][0] + segment.gone
        return counted(segment, named, conv) | {"open": False, "cost": cost, "audit": audit, "sha": sha}

    def results() -> Iterator[dict]:
        at_start, held = True, None
        for (named, conv), group in groupby(rows(), key=lambda row: row[:2]):
            if held is not None:  # the conversation before this one is not the range's last
                yield (opened if at_start else closed)(*held)
                at_start = False
            segment, cut = Segment(), False
            for row in group:
                if segment.rows and (len(segment.deletes) > rows_each or segment.bytes > chars_each):
                    yield opened(segment, named, conv)
                    segment, cut = Segment(), True
                segment.add(*row[2:])
            held = (segment, named, conv)
            if cut:
                yield opened(*held)
                held, at_start = None, False
        if held is not None:
            yield opened(*held)

    for result in results():
        waiting.append(result)
        if len(waiting) == 256 or result["open"]:
            yield pa.RecordBatch.from_pylist(waiting, schema=schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, schema=schema)


def _joined(segments: pd.DataFrame) -> pd.DataFrame:
    """The segments of one conversation in order → vector after and state before each; the conversation's counts."""
    book = tables()
    parts = segments.sort_values("place").to_dict("records")
    exits, vector, cost = [], book.end, 0
    for part in reversed(parts):
        exits.append(vector)
        cost += int(part["added"][vector]) + int(part["gone"])
        vector = int(part["back"][vector])
    cost += book.vectors[vector][0]
    states, state = [], 0
    for part, exit in zip(parts, reversed(exits), strict=True):
        states.append(state)
        state = int(part["steps"][4 * exit + state])
    totals = {name: sum(int(part[name]) for part in parts) for name in ("rows", "blank", "duplicate", "truncated", "illegal", "turns")}
    held = [part for part in parts if part["rows"]]
    for before, after in zip(held, held[1:], strict=False):
        totals["illegal"] += before["last"] + after["first"] not in ("su", "ua", "au")
    ranges = [(int(part["low"]), int(part["high"])) for part in parts if not pd.isna(part["low"])]
    totals["turns"] -= sum(before[1] == after[0] for before, after in zip(ranges, ranges[1:], strict=False))
    low, high = (ranges[0][0], ranges[-1][1]) if ranges else (None, None)
    result = pd.DataFrame({"conv": segments["conv"].iloc[0], "named": segments["named"].iloc[0], "place": [p["place"] for p in parts]})
    result["exit"], result["state"] = exits[::-1], states
    result["is_last"] = [False] * (len(parts) - 1) + [True]
    for name, value in totals.items():
        result[name] = value
    result["low"], result["high"] = pd.array([low] * len(parts), "Int64"), pd.array([high] * len(parts), "Int64")
    result["cost"] = cost
    return result


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open segments with their vector and state → edits, repaired rows as text."""
    names = ["conv", "named", "place", "audit", "repaired"]
    for batch in batches:
        for row in range(batch.num_rows):
            conv, named, place, exit, state, is_last, symbols, deletes, roles, texts = (c[row].as_py() for c in batch.columns)
            segment = Segment()
            segment.symbols, segment.deletes, segment.roles, segment.texts = symbols, deletes, roles, texts
            audit, rows = segment.repaired(exit, state, is_last)
            values = [conv, named, place, audit, "\n".join(rows) if rows else None]
            types = [pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Expanded segments in order → one row per conversation, holding only the digest and the edits."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield tuple(column[row].as_py() for column in batch.columns)

    for (conv, named), group in groupby(rows(), key=lambda row: row[:2]):
        digest, audit, any_row = hashlib.sha256(), [], False
        for _, _, _, initials, repaired in group:
            audit.append(initials)
            if repaired is not None:
                digest.update((("\n" if any_row else "") + repaired).encode())
                any_row = True
        columns = [pa.array([conv]), pa.array([named]), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])]
        yield pa.RecordBatch.from_arrays(columns, names=["conv", "named", "audit", "sha"])


# --- Spark ------------------------------------------------------------------------------------------------------


def counted_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str, times: Column) -> DataFrame:
    """Different rows with their number, and whether a role and text stand here for the first time.

    Keys are never null (a flag says so), so that the count and the join share one partitioning.
    """
    space = F.lit(" ")
    given = rows.select(
        F.col(conv).isNotNull().alias("named"),
        F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("conv"),
        F.col(turn).isNotNull().alias("timed"),
        F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"),
        times.cast("long").alias("times"),
    ).withColumn("digest", F.sha2(whole("text"), 256))
    keys = ["named", "conv", "timed", "turn", "role", "digest"]
    different = given.groupBy(*keys).agg(F.sum("times").alias("times"), F.max("text").alias("text"))
    said = given.where("times > 0").groupBy("named", "conv", "role", "digest")
    earliest = said.agg(F.min("timed").alias("timed"), F.min("turn").alias("least"))  # without a null, all turns are timed
    earliest = earliest.select(
        "named", "conv", "timed", F.when(F.col("timed"), F.col("least")).otherwise(0).alias("turn"), "role", "digest",
        F.lit(True).alias("is_first"),
    )
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    return (
        different.join(earliest, keys, "left")
        .select(
            "named", "conv", "timed", "turn", "role", "text", "times",
            (bare == "").alias("blank"),
            F.coalesce("is_first", F.lit(False)).alias("first"),
            F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ended"),
        )
    )


def repair(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    times: Column | None = None,
    rows_each: int = 4096,
    chars_each: int = 1 << 22,
) -> DataFrame:
    """One row per conversation: `conv`, `gaps`, `blank`, `duplicate`, `truncated`, `illegal`, `cost`, `audit`, `repaired_sha256`.

    `times` says how often a row stands there (once by default).
    """
    kind = rows.schema[conv].dataType
    prepared = counted_rows(rows, conv, turn, role, text, F.lit(1) if times is None else times)
    # The range key is a beginning of the order, so equal beginnings share a range and the order holds across ranges.
    start = F.substring("text", 1, 32)
    order = ["named", "conv", "timed", "turn", "role"]
    ranged = prepared.repartitionByRange(*order, start).sortWithinPartitions(*order, "text")
    timed = F.when(F.col("timed"), F.col("turn")).alias("turn")
    ranged = ranged.select("named", "conv", timed, "role", "text", "times", "blank", "first", "ended")
    schema = T.DataType.fromDDL(_SEGMENT)
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _segments(batches, rows_each, chars_each, arrow)

    segments = stored(ranged.mapInArrow(cut, schema), "segments")
    done = segments.where("not open")
    parts = segments.where("open")
    small = ["named", "conv", "place", *_COUNTS, "gone", "first", "last", "back", "added", "steps"]
    numbers = ", ".join(f"{c} long" for c in [*_COUNTS, "cost"])
    joined = f"conv string, named boolean, place long, exit int, state int, is_last boolean, {numbers}"
    chained = stored(parts.select(small).groupBy("named", "conv").applyInPandas(_joined, joined), "chained")
    content = parts.select("place", "symbols", "deletes", "roles", "texts")
    told = chained.select("conv", "named", "place", "exit", "state", "is_last").join(content, "place")
    told = told.select("conv", "named", "place", "exit", "state", "is_last", "symbols", "deletes", "roles", "texts")
    pieces = told.mapInArrow(_expand, "conv string, named boolean, place long, audit string, repaired string")
    pieces = pieces.repartition("named", "conv").sortWithinPartitions("named", "conv", "place")
    digests = pieces.mapInArrow(_digests, "conv string, named boolean, audit string, sha string")
    totals = chained.where("is_last").select("conv", "named", *_COUNTS, "cost")
    columns = ["named", "conv", *_COUNTS, "cost", "audit", "sha"]
    both = done.select(columns).unionByName(totals.join(digests, ["conv", "named"]).select(columns))
    return both.select(
        F.when(F.col("named"), F.col("conv")).cast(kind).alias(conv),
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("sha").alias("repaired_sha256"),
    )
