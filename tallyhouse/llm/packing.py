"""Best-fit packing of tokenised documents, after a dominance reduction of the instance.

The instance of a bin packing problem with integer sizes is its histogram: at most `capacity` lengths and their
counts, whatever the number of documents.  Spark tokenises and counts; the driver gets the histogram (a proven
bound of `capacity` rows), fixes dominating sets (Martello and Toth's reduction), packs the rest by best fit with
decreasing lengths, and sends back runs: "documents number a to b of length l go into sequences s, s+1, ...".
Spark numbers the documents of each length and looks the runs up.  No document and no sequence passes the driver.

Numbering is by a hash bucket and then by key, never by arrival, so a repeated task numbers alike; a hot length (many
copies of a document) is spread over the buckets.

Edge cases: a null or empty text is its end id alone (length 1); repeated rows are packed as documents of their own;
an empty table gives an empty table; other input columns are ignored whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm import vocabulary
from tallyhouse.llm.texts import whole
from tallyhouse.sources.scratch import stored

Run = tuple[int, int, int, int, int, int]  # length, first number, last number + 1, first sequence, per sequence, offset


def token_ids(text: str, ranks: str | None, end: int, piece_chars: int) -> np.ndarray:
    """The ids of a whole text and its end id, as unsigned 32-bit integers."""
    encoder = vocabulary.encoder(ranks)
    parts = [
        np.asarray(encoder.encode(piece, allowed_special="all"), "<u4") for piece in vocabulary.safe_pieces(text, piece_chars)
    ]
    return np.concatenate([*parts, np.asarray([end], "<u4")])


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece; only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *((start, capacity) for start in range(first, n, capacity))]


def pieces(
    docs: DataFrame,
    capacity: int,
    key: str = "doc_id",
    text: str = "text",
    ranks: str | None = None,
    end: int = 0,
    with_ids: bool = False,
    piece_chars: int = 1 << 16,
) -> DataFrame:
    """Key, `piece`, `start`, `length`, `ids_crc32` of each piece of each document, on request with its `ids`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, starts, sizes, sums, ids = [], [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                found = token_ids(value.as_py(), ranks, end, piece_chars)
                for number, (start, size) in enumerate(cuts(len(found), capacity)):
                    part = found[start : start + size]
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    sizes.append(size)
                    sums.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids.append(part)
            columns = [batch.column(0).take(pa.array(rows, pa.int32())), pa.array(numbers, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (starts, sizes, sums)]
            names = ["key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.uint32())).cast(pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    texts = docs.select(F.col(key).alias("key"), whole(text).alias("text"))
    fields = [texts.schema["key"], T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    return texts.mapInArrow(cut, T.StructType(fields)).withColumnRenamed("key", key)


class Plan:
    """Hands out the numbered items of a histogram to sequences."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = [0] * (capacity + 1)
        for length, count in histogram.items():
            self.left[length] = count
        self.next = [0] * (capacity + 1)
        self.sequences = 0
        self.runs: list[Run] = []

    def emit(self, pattern: list[tuple[int, int]], times: int) -> None:
        """`times` sequences that each hold, for (length, count) in order, `count` items of that length."""
        offset = 0
        for length, count in pattern:
            first = self.next[length]
            self.next[length] = first + times * count
            self.runs.append((length, first, first + times * count, self.sequences, count, offset))
            offset += length * count
        self.sequences += times

    def take(self, pattern: list[tuple[int, int]], times: int) -> None:
        for length, count in pattern:
            self.left[length] -= times * count
        self.emit(pattern, times)


def reduce_dominated(plan: Plan) -> None:
    """Fix sets that dominate every other set with their largest item, until none is left to fix.

    Beside an item of length w there is room r.  Let s be the longest item that fits.  {w, s} dominates all sets
    with w if no two or more items that fit together are longer than s: when s fills the room, when not even the two
    shortest items fit together, or when three do not and the best two are no longer than s.  If nothing fits, {w}.
    """
    left, c = plan.left, plan.capacity
    changed = True
    while changed:
        changed = False
        for w in range(c, 0, -1):
            while left[w]:
                left[w] -= 1  # one item of this length is placed; what else is there?
                room = c - w
                s = next((x for x in range(min(room, c), 0, -1) if left[x]), 0)
                fits = s == 0 or s == room or _best_of_many(left, room, s) <= s
                left[w] += 1
                if not fits:
                    break
                if s == 0:
                    plan.take([(w, 1)], left[w])
                elif s == w:
                    plan.take([(w, 2)], left[w] // 2)
                else:
                    # Taking the last item of length s may change which set dominates, so the loop looks again.
                    plan.take([(w, 1), (s, 1)], min(left[w], left[s]))
                changed = True


def _best_of_many(left: list[int], room: int, enough: int) -> int:
    """The largest total of two items that fit, or more than `enough` if three or more fit."""
    shortest: list[int] = []
    for x in range(1, room + 1):
        shortest += [x] * min(left[x], 3 - len(shortest))
        if len(shortest) == 3:
            break
    if len(shortest) < 2 or shortest[0] + shortest[1] > room:
        return 0
    if len(shortest) == 3 and sum(shortest) <= room:
        return enough + 1
    best, low = 0, 1
    high = room - 1
    while low <= high:
        if not left[low] or (low == high and left[low] < 2):
            low += 1
        elif not left[high]:
            high -= 1
        elif low + high > room:
            high -= 1
        else:
            best = max(best, low + high)
            low += 1
    return best


def best_fit(plan: Plan) -> None:
    """Decreasing lengths, each item into the open sequence with the least room that holds it.

    Equal sequences are kept as one group, and equal items are dealt to a group at once.
    """
    groups: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}  # room → [(pattern, sequences)]
    for w in range(plan.capacity, 0, -1):
        n = plan.left[w]
        plan.left[w] = 0
        # A sequence that takes an item has less room than before, so it is the best fit for the next one as well.
        for room in sorted(r for r in groups if r >= w):
            while n and groups.get(room):
                pattern, times = groups[room].pop()
                each = room // w
                full = min(times, n // each)
                if full:
                    groups.setdefault(room - each * w, []).append((pattern + [(w, each)], full))
                    n -= full * each
                    times -= full
                if n and times:
                    groups.setdefault(room - n * w, []).append((pattern + [(w, n)], 1))
                    n = 0
                    times -= 1
                if times:
                    groups[room].append((pattern, times))
            if not n:
                break
        each = plan.capacity // w
        if n >= each:
            groups.setdefault(plan.capacity - each * w, []).append(([(w, each)], n // each))
        if n % each:
            groups.setdefault(plan.capacity - (n % each) * w, []).append(([(w, n % each)], 1))
    for room in sorted(groups):
        for pattern, times in groups[room]:
            plan.emit(pattern, times)


def solve(histogram: dict[int, int], capacity: int) -> Plan:
    plan = Plan(histogram, capacity)
    reduce_dominated(plan)
    best_fit(plan)
    return plan


def pack(items: DataFrame, capacity: int, order: list[str], buckets: int = 64) -> DataFrame:
    """Adds `sequence_id` and `offset` to a table with a `length` column.

    `order` names columns that tell rows apart; rows equal in all of them must be equal in the rest.  `items` is read
    twice, so give a stored table.
    """
    spark = items.sparkSession
    counts = items.groupBy("length").count().collect()  # at most `capacity` rows
    plan = solve({row["length"]: row["count"] for row in counts}, capacity)
    runs = spark.createDataFrame(
        plan.runs,
        "run_length long, first long, last long, first_sequence long, per_sequence long, first_offset long",
    )
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets))
    dealt = items.select(F.struct("*").alias("item"), F.col("length").alias("run_length"), bucket.alias("bucket"))
    sizes = dealt.groupBy("run_length", "bucket").count()
    before = Window.partitionBy("run_length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("skip", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = Window.partitionBy("run_length", "bucket").orderBy(*[F.col(f"item.{name}") for name in order])
    numbered = (
        dealt.withColumn("place", F.row_number().over(within) - 1)
        .join(sizes, ["run_length", "bucket"])
        .withColumn("number", F.col("place") + F.col("skip"))
    )
    # Proven bound: best fit leaves at most three groups a length, a group at most 63 distinct lengths.
    found = numbered.join(
        F.broadcast(runs), ["run_length"]
    ).where("number >= first and number < last")
    step = F.col("number") - F.col("first")
    return found.select(
        "item.*",
        (F.col("first_sequence") + F.floor(step / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + (step % F.col("per_sequence")) * F.col("run_length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, capacity: int = 2048, key: str = "doc_id", text: str = "text", with_ids: bool = False, **options
) -> DataFrame:
    """Every piece of every document with its place; `with_ids` keeps the ids, which `sequences` joins."""
    items = stored(pieces(docs, capacity, key, text, with_ids=with_ids, **options), "pieces")
    return pack(items, capacity, [key, "piece", "start", "length", "ids_crc32"])


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ids in order, at most `capacity` in a group."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda part: part["ids"])).alias("ids"))
