"""Hard negatives by a vertical scan of columnar vectors (BOND).

Rows are kept by column: a block holds some thousand vectors as one array per dimension, sorted by label.  For an anchor the
dimensions are read in the order of the anchor's magnitudes, the largest first.  What the unread dimensions can still add lies
between the sums of the block's smallest and largest contributions, so every row has a lower and an upper bound of its score.
After each step a row leaves the block's bitmap

* in the search for positives, if its upper bound is below the k-th largest lower bound among rows of the anchor's label;
* in the search for negatives, if its bounds meet no window of a positive, or k rows that are surely inside have larger
  lower bounds.

Rows still in the bitmap when all dimensions are read have exact scores.  Bounds are compared strictly, so ties stay.

The anchors are a stated query set and meet every block: packs of anchors are joined with blocks, broadcast while all packs
together are below `broadcast_bytes`, else both sides are dealt by (pack, block).  A task reads one block after another and keeps the best k rows of each
anchor (and window) of its packs, which bound the next block's scan from below; it gives back those, and the best k of all
tasks are found by rank.  Blocks are dealt by a hash of the row, so a hot label fills no task.

Scores are exact integers: doubles while every sum of products stays below 2^53, Python integers beyond, cut to the range of
a long at the end.

Edge cases: rows with a null label, a null vector or a null or non-finite component take no part (nor rows whose scaled component
is no double); vectors of different lengths never meet; a vector without components scores 0; a null id is no anchor and comes
last among ties, and is returned as null; rows with the anchor's id are no positives or negatives of it; repeated rows stay rows
of their own; an empty table gives an empty table; other input columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.sources.scratch import stored

_NO_ID = np.iinfo(np.int64).max
_EXACT = float(1 << 53)
BLOCK = "dims int, n int, ids binary, labels binary, columns binary"


# --- columns ----------------------------------------------------------------------------------------------------


def usable(rows: DataFrame, key: str, label: Column, vector: str) -> DataFrame:
    """Rows that take part: `id`, `label`, `vector` (doubles)."""
    doubles = F.col(vector).cast("array<double>").alias("vector")
    picked = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), doubles)
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * 256) == float("inf")))
    return picked.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd)


def columnar(rows: DataFrame, at_most: int) -> DataFrame:
    """Blocks of at most so many vectors of equal length from each partition: whole numbers, one array per dimension."""

    def block(dims: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, labels, values = (np.concatenate([part[i] for part in parts]) for i in range(3))
        order = np.lexsort((ids, labels))
        columns = np.ascontiguousarray(values[order].T, "<f8")
        arrays = [pa.array([x], pa.int32()) for x in (dims, len(ids))]
        held = (ids[order].astype("<i8"), labels[order].astype("<i8"), columns)
        arrays += [pa.array([x.tobytes()], pa.binary()) for x in held]
        return pa.RecordBatch.from_arrays(arrays, names=["dims", "n", "ids", "labels", "columns"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            labels, vectors = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2)
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            values, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
            for dims in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dims)
                taken = np.floor(256 * values[(ends[rows] - dims)[:, None] + np.arange(dims)])
                for start in range(0, len(rows), at_most):
                    some = slice(start, start + at_most)
                    parts = waiting.setdefault(dims, [])
                    parts.append((ids[rows[some]], labels[rows[some]], taken[some]))
                    if sum(len(part[0]) for part in parts) >= at_most:
                        yield block(dims, waiting.pop(dims))
        for dims, parts in waiting.items():
            yield block(dims, parts)

    return rows.mapInArrow(gather, BLOCK)


class Block:
    """A block's arrays, with the smallest and largest value of each dimension over all rows and by label."""

    def __init__(self, dims: int, n: int, ids: bytes, labels: bytes, columns: bytes):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.columns = np.frombuffer(columns, "<f8").reshape(dims, n)
        self.largest = float(np.abs(self.columns).max(initial=0))
        self._range: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def rows_of(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))

    def ranges(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest value of each dimension among rows `start` to `stop`."""
        if (start, stop) not in self._range:
            some = self.columns[:, start:stop]
            self._range[start, stop] = (some.min(axis=1), some.max(axis=1)) if stop > start else (np.zeros(len(some)),) * 2
        return self._range[start, stop]


def scan(
    block: Block,
    anchor: np.ndarray,
    start: int,
    stop: int,
    alive: np.ndarray,
    keep: Callable[[np.ndarray, np.ndarray], np.ndarray],
    step: int = 8,
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `start` to `stop` that stay in the bitmap `alive`, and their scores.

    `keep` gets lower and upper bounds of the rows still alive and says which stay.
    """
    low, high = block.ranges(start, stop)
    order = np.argsort(-np.abs(anchor), kind="stable")
    whole = len(anchor) * block.largest * float(np.abs(anchor).max(initial=0)) >= _EXACT
    if whole:  # beyond exact doubles: Python integers
        to_int = np.frompyfunc(int, 1, 1)
        anchor, low, high = (to_int(x).astype(object) for x in (anchor, low, high))
    least, most = np.minimum(anchor * low, anchor * high)[order], np.maximum(anchor * low, anchor * high)[order]
    # What the dimensions from place k of the order on add at least and at most.
    least, most = (np.append(np.cumsum(x[::-1])[::-1], 0) for x in (least, most))
    rows = np.flatnonzero(alive)
    scores = np.zeros(len(rows), object if whole else np.float64)
    dense = len(rows) == stop - start
    for place in range(0, len(order), step):
        if not len(rows):
            break
        dims = order[place : place + step]
        read = block.columns[dims, start:stop] if dense else block.columns[dims[:, None], start + rows]
        scores = scores + anchor[dims] @ (to_int(read).astype(object) if whole else read)
        end = place + len(dims)
        stays = keep(scores + least[end], scores + most[end])
        if not stays.all():
            rows, scores, dense = rows[stays], scores[stays], False
    return start + rows, scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by descending score, then ascending id."""
    if len(scores) > k:
        bar = np.sort(scores)[-k] if scores.dtype == object else np.partition(scores, -k)[-k]
        places = np.flatnonzero(scores >= bar)
    else:
        places = np.arange(len(scores))
    if scores.dtype == object:
        return np.asarray(sorted(places.tolist(), key=lambda p: (-scores[p], ids[p]))[:k], np.int64)
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def kth_largest(values: np.ndarray, k: int):
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, -k)[-k]


Found = tuple[np.ndarray, np.ndarray]  # ids and scores, the best first


def better(known: Found | None, ids: np.ndarray, scores: np.ndarray, k: int) -> Found:
    """The k best of those known and new ones."""
    if known is not None:
        ids, scores = np.concatenate([known[0], ids]), np.concatenate([known[1], scores])
    first = best(scores, ids, k)
    return ids[first], scores[first]


def bar_of(known: Found | None, k: int):
    """What a score must reach to be among the k best, so far."""
    return known[1][-1] if known is not None and len(known[1]) == k else None


def nearest(block: Block, anchor: np.ndarray, label: int, own: int, k: int, known: Found | None = None) -> Found:
    """The k best rows of the anchor's label in a block and among those known from other blocks."""
    start, stop = block.rows_of(label)
    bar = bar_of(known, k)

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stays = upper >= kth_largest(lower, k) if len(lower) > k else np.ones(len(lower), bool)
        return stays if bar is None else stays & (upper >= bar)

    rows, scores = scan(block, anchor, start, stop, block.ids[start:stop] != own, keep)
    return better(known, block.ids[rows], scores, k)


def inside(
    block: Block,
    anchor: np.ndarray,
    label: int,
    own: int,
    windows: list[tuple[int, int]],
    k: int,
    known: list[Found | None] | None = None,
) -> list[Found]:
    """For each window (least, most score) the k best rows of other labels in a block and among those known."""
    start, stop = block.rows_of(label)
    alive = block.ids != own
    alive[start:stop] = False
    known = known or [None] * len(windows)
    bars = [least if (bar := bar_of(found, k)) is None else max(least, bar) for (least, _), found in zip(windows, known, strict=True)]

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(lower), bool)
        for (least, most), bar in zip(windows, bars, strict=True):
            sure = lower[(lower >= least) & (upper <= most)]
            reach = max(bar, kth_largest(sure, k)) if len(sure) >= k else bar
            stays |= (upper >= reach) & (lower <= most)
        return stays

    rows, scores = scan(block, anchor, 0, len(block.ids), alive, keep)
    ids, results = block.ids[rows], []
    for (least, most), found in zip(windows, known, strict=True):
        held = (scores >= least) & (scores <= most)
        results.append(better(found, ids[held], scores[held], k))
    return results


# --- Spark ------------------------------------------------------------------------------------------------------


def pairs(packs: DataFrame, blocks: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Every pack beside every block of vectors of the same length."""
    size = packs.agg(F.sum(F.octet_length("pack_columns") + F.octet_length("pack_ids"))).first()[0] or 0
    if size <= broadcast_bytes:
        return blocks.join(F.broadcast(packs), F.col("dims") == F.col("pack_dims"))
    # Both sides are dealt by (pack, deal), so that one vector length fills no task.
    deals = 64
    numbers = packs.select("pack_dims", "pack")
    dealt = blocks.withColumn("deal", F.pmod(F.xxhash64("ids"), F.lit(deals)))
    dealt = dealt.join(F.broadcast(numbers), F.col("dims") == F.col("pack_dims")).drop("pack_dims")
    spread = packs.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))))
    return dealt.join(spread, ["pack", "deal"])


def first_of(found: DataFrame, group: list[str], k: int) -> DataFrame:
    """The first k rows of each group by score and id, numbered by `rank`."""
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("found").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _longs(scores: np.ndarray) -> pa.Array:
    """Whole scores as longs, cut to their range."""
    if scores.dtype == object:
        return pa.array([max(-_NO_ID - 1, min(_NO_ID, int(x))) for x in scores], pa.int64())
    return pa.array(scores.astype(np.int64), pa.int64())


def _ids(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == _NO_ID)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    label: Column | None = None,
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    block_rows: int = 8192,
    pack_rows: int = 4096,
    broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    `is_anchor` is a condition on `id`.  An anchor's positives are the first rows of its label by inner product of
    floor(256 * component).  Negatives of a positive are the first rows of other labels whose score lies between the given
    percentages of the positive's.
    """
    rows = usable(rows, key, F.col("label") if label is None else label, vector)
    counted = rows.agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    deal = [F.col("id"), F.xxhash64("vector")]
    blocks = stored(columnar(rows.repartition(-(-counted["n"] // block_rows) or 1, *deal), block_rows), "columns")
    anchors = rows.where(is_anchor).repartition(-(-counted["anchors"] // pack_rows) or 1, *deal)
    packs = columnar(anchors, pack_rows).withColumn("pack", F.monotonically_increasing_id())
    packs = packs.select("pack", *[F.col(name).alias(f"pack_{name}") for name in ("dims", "n", "ids", "labels", "columns")])
    packs = stored(packs, "anchors")
    cells = ["dims", "n", "ids", "labels", "columns", "pack", "pack_n", "pack_ids", "pack_labels", "pack_columns"]

    def held(batch: pa.RecordBatch) -> Iterator[tuple]:
        for i in range(batch.num_rows):
            dims, n, ids, labels, columns, pack, pack_n, pack_ids, pack_labels, pack_columns = (
                batch.column(c)[i].as_py() for c in range(10)
            )
            yield Block(dims, n, ids, labels, columns), pack, Block(dims, pack_n, pack_ids, pack_labels, pack_columns), i

    # A task keeps the best rows of its packs over all blocks it reads: each block is held against what others gave.

    def search_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, dict[tuple[int, ...], Found]] = {}
        for batch in batches:
            for block, pack, anchors, _ in held(batch):
                mine = kept.setdefault(pack, {})
                for place, own in enumerate(anchors.ids.tolist()):
                    vector, label = anchors.columns[:, place].copy(), int(anchors.labels[place])
                    mine[place,] = nearest(block, vector, label, own, positives, mine.get((place,)))
        yield from _rows(kept, ["place"])

    def search_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, dict[tuple[int, ...], Found]] = {}
        for batch in batches:
            for block, pack, anchors, row in held(batch):
                mine = kept.setdefault(pack, {})
                windows: dict[int, list[tuple[int, int, int]]] = {}
                for place, number, score in (tuple(w.values()) for w in batch.column(10)[row].as_py()):
                    # low% <= score <= high% in whole numbers
                    least, most = -(-low_percent * score // 100), high_percent * score // 100
                    if least <= most:
                        windows.setdefault(place, []).append((number, least, most))
                for place, asked in windows.items():
                    vector, label, own = anchors.columns[:, place].copy(), int(anchors.labels[place]), int(anchors.ids[place])
                    known = [mine.get((place, number)) for number, _, _ in asked]
                    found = inside(block, vector, label, own, [w[1:] for w in asked], negatives, known)
                    mine |= {(place, number): some for (number, _, _), some in zip(asked, found, strict=True)}
        yield from _rows(kept, ["place", "positive"])

    both = pairs(packs, blocks, broadcast_bytes).select(cells)
    near = both.mapInArrow(search_positives, "pack long, place int, found long, score long")
    near = stored(first_of(near, ["pack", "place"], positives), "positives")
    window = F.struct("place", F.col("rank").alias("number"), "score")
    asked = near.groupBy("pack").agg(F.collect_list(window).alias("windows"))  # at most pack_rows * positives
    wanted = pairs(packs, blocks, broadcast_bytes).select(cells).join(asked, "pack").select(*cells, "windows")
    far = wanted.mapInArrow(search_negatives, "pack long, place int, positive int, found long, score long")
    far = first_of(far, ["pack", "place", "positive"], negatives).withColumnsRenamed({"found": "negative", "score": "negative_score"})
    owners = packs.select("pack", "pack_ids").mapInArrow(_owners, "pack long, place int, anchor long")
    named = near.join(owners, ["pack", "place"]).withColumnsRenamed({"rank": "positive", "found": "positive_id"})
    return far.join(named, ["pack", "place", "positive"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        far["rank"].cast("int").alias("rank"),
        F.col("negative").alias("negative_id"),
        F.col("score").alias("positive_score"),
        "negative_score",
    )


def _rows(kept: dict[int, dict[tuple[int, ...], Found]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """A batch per pack: pack, the parts of the key, id found, score."""
    for pack, found in kept.items():
        sizes = [len(ids) for ids, _ in found.values()]
        keys = np.repeat(np.asarray(list(found), np.int64).reshape(len(found), len(names)), sizes, axis=0)
        arrays = [pa.array(np.full(len(keys), pack), pa.int64()), *(pa.array(keys[:, i], pa.int32()) for i in range(len(names)))]
        arrays.append(_ids(np.concatenate([np.zeros(0, np.int64), *(ids for ids, _ in found.values())])))
        arrays.append(pa.concat_arrays([pa.array([], pa.int64()), *(_longs(scores) for _, scores in found.values())]))
        yield pa.RecordBatch.from_arrays(arrays, names=["pack", *names, "found", "score"])


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The id of each anchor by pack and place."""
    for batch in batches:
        for pack, ids in zip(batch.column(0), batch.column(1), strict=True):
            owned = np.frombuffer(ids.as_py(), "<i8")
            arrays = [pa.array([pack.as_py()] * len(owned), pa.int64()), pa.array(np.arange(len(owned)), pa.int32())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(owned, pa.int64())], names=["pack", "place", "anchor"])
