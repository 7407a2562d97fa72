"""Near-duplicate vectors: learned rotations, multi-index Hamming tables, rerank with the vectors.

Iterative quantisation learns, on a bounded sample, rotations of the centred vectors that make balanced binary codes
with little loss; several starts give codes of any length.  A code is cut into tables of `s` bits; two vectors are
retrieved if a table has them in one bucket and their whole codes are within a Hamming radius.

Bits differ at unlike rates for unlike pairs (a dense cluster far from the centre, a strong common mean), so nothing is
derived from a mean rate.  Pairs just at the threshold are made from the sample in three ways: along random directions, along
differences of vectors of the sample, and those that the sample holds itself.  Tables are added until the pairs of each
kind that share none are at most a share `miss` of it, and the radius holds all but as many of them.  The bits of a table are
those that cost least, by the rows sent and the pairs met in buckets of the sample.  Only where no number of tables up to
`MOST_TABLES` keeps the promise are all vectors compared in blocks.

1. Equal vectors become one node with a count, so a very common vector costs one row.
2. Codes only, 30 to 60 bytes a row, go to the buckets; a vector leaves a bucket only if it has a partner there.
3. The vectors of those go to the same buckets and are compared in double precision.  A pair counts in the first
   table that it shares, so once.  A task gives back sums per vector and stars of links, never pairs.

Buckets with many vectors are cut into chunks, and each two chunks meet in a task of their own.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and vectors of another
dimension, link with nothing; a null id takes part and is not chosen as a smallest id unless all are null; repeated
rows are vectors of their own; an empty table gives an empty table; other columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.components import components, stars
from tallyhouse.sources.scratch import stored


@dataclass(frozen=True)
class Codes:
    """Centre, projections (dimensions × bits), bits a table, tables and Hamming radius."""

    centre: np.ndarray
    projections: np.ndarray
    table_bits: int
    tables: int
    radius: int

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Bucket of each vector in each table."""
        if not self.table_bits:  # one bucket for all
            return np.zeros((len(vectors), 1), np.int64)
        ones = (unit(vectors) - self.centre) @ self.projections > 0
        grouped = ones.reshape(len(vectors), self.tables, self.table_bits)
        return grouped @ (1 << np.arange(self.table_bits, dtype=np.int64))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that squares stay finite."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def rotation(data: np.ndarray, rng: np.random.Generator, rounds: int) -> np.ndarray:
    """An orthogonal matrix that brings centred data close to the corners of the cube (iterative quantisation)."""
    turn, _ = np.linalg.qr(rng.normal(size=(data.shape[1], data.shape[1])))
    for _ in range(rounds):
        corners = np.where(data @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(corners.T @ data)
        turn = (left @ right).T
    return turn


def pairs_at(threshold: float, data: np.ndarray, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors with a cosine at the threshold (the last kind: a little above), made from a sample."""

    def turned(away: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        away = away - (away * data).sum(1, keepdims=True) * data
        norms = np.linalg.norm(away, axis=1)
        some = norms > 1e-9
        away = away[some] / norms[some, None]
        return data[some], threshold * data[some] + math.sqrt(max(0.0, 1 - threshold**2)) * away

    other, third = (data[rng.permutation(len(data))] for _ in range(2))
    kinds = [turned(rng.normal(size=data.shape)), turned(other - third)]
    left, right = [], []
    for at in range(0, len(data), 512):  # pairs that the sample holds
        cosines = data[at : at + 512] @ data.T
        i, j = np.nonzero((cosines >= threshold) & (cosines < threshold + (1 - threshold) / 4))
        left.append((i + at)[i + at < j])
        right.append(j[i + at < j])
    i, j = np.concatenate(left), np.concatenate(right)
    if len(i) > len(data):
        some = rng.permutation(len(i))[: len(data)]
        i, j = i[some], j[some]
    kinds.append((data[i], data[j]))
    return [kind for kind in kinds if len(kind[0])]


#: Seconds that a row in a bucket costs (coded, sent, sorted, sent again with its vector) and that a pair of rows in one costs.
ROW_COST, PAIR_COST = 1e-5, 1.5e-7
MOST_TABLES = 512


def learn(sample: np.ndarray, n: int, threshold: float, miss: float, rounds: int = 20, seed: int = 11) -> Codes:
    """Codes for `n` vectors like those of the sample."""
    rng = np.random.default_rng(seed)
    data = unit(sample)
    centre = data.mean(0)
    d = data.shape[1]
    _, axes = np.linalg.eigh((data - centre).T @ (data - centre))
    tested = data[rng.permutation(len(data))[:4000]]
    kinds = pairs_at(threshold, tested, rng)
    projected = (tested - centre) @ axes
    turns: list[np.ndarray] = []

    def projections(bits: int) -> np.ndarray:
        while len(turns) * d < bits:
            turns.append(axes @ rotation(projected, rng, rounds))
        return np.concatenate(turns, axis=1)[:, :bits]

    def differ(bits: int) -> list[np.ndarray]:
        directions = projections(bits)
        return [((a - centre) @ directions > 0) != ((b - centre) @ directions > 0) for a, b in kinds]

    def tables_for(bits: int, rates: list[np.ndarray]) -> int:
        """Tables with which the mean chance of sharing none is small enough for every kind of pairs."""
        count = 1
        for rate in rates:
            apart = 1 - (1 - rate) ** bits
            while count <= MOST_TABLES and (apart**count).mean() > miss:
                count = count + 1 + count // 8
        return count

    rates = [found.mean(1) for found in differ(max(256, 4 * d))]
    mine, others = tested[: len(tested) // 2], tested[len(tested) // 2 :][: len(tested) // 2]
    signs = [(x - centre) @ projections(60) > 0 for x in (mine, others[: len(mine)])]
    choices = []
    for bits in range(4, 31):
        tables = tables_for(bits, rates)
        if tables > MOST_TABLES:
            break
        # How often two vectors of the sample share a bucket; a count of none stands for less than one.
        shared = [(signs[0][:, at : at + bits] == signs[1][:, at : at + bits]).all(1).mean() for at in range(0, 60 - bits + 1, bits)]
        alike = max(float(np.mean(shared)), 2.0**-bits) if len(mine) else 1.0
        choices.append((tables * (n * ROW_COST + n * n / 2 * alike * PAIR_COST), bits, tables))
    if not choices:  # one bucket for all, in blocks
        return Codes(centre, np.zeros((d, 0)), 0, 1, 0)
    _, bits, tables = min(choices)
    while True:  # the tables as they are, on the pairs
        found = differ(bits * tables)
        tables_met = [(~x.reshape(len(x), tables, bits).any(2)).any(1) for x in found]
        if tables >= MOST_TABLES or all(1 - met.mean() <= miss for met in tables_met):
            break
        tables = tables + 1 + tables // 6
    apart = [x[met].sum(1) for x, met in zip(found, tables_met, strict=True) if met.any()]
    radius = max((math.ceil(np.quantile(counts, 1 - miss / 2)) for counts in apart), default=0)
    return Codes(centre, projections(bits * tables), bits, tables, radius + math.ceil(0.02 * bits * tables))


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows, so cut that the rows of a group (first column) are never parted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(0).to_numpy()
        last = int(np.searchsorted(group, group[-1]))  # where the batch's last group begins
        if last or (held and held[-1].column(0)[-1].as_py() != group[0]):
            if last:
                held.append(batch.slice(0, last))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def pairs_of(group: np.ndarray, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all two rows of a group, at most about `at_once` pairs at a time."""
    ends = np.searchsorted(group, group, side="right")
    after = ends - np.arange(len(group)) - 1
    total = np.cumsum(after)
    at = 0
    while at < len(group):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + at_once)))
        part = np.arange(at, upto)
        left = np.repeat(part, after[part])
        skip = np.repeat(np.cumsum(after[part]) - after[part], after[part])
        yield left, left + 1 + np.arange(len(left)) - skip
        at = upto


def _partners(radius: int, pairs_at_once: int = 1 << 19):
    """From (group, node, chunk, split, code): the rows that have a partner within the radius."""

    def retrieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            group, chunk = rows["group"].to_numpy(), rows["chunk"].to_numpy()
            split = rows["split"].to_numpy()
            packed = b"".join(rows["code"].to_pylist())
            code = np.frombuffer(packed, "<u8").reshape(len(group), -1)
            partnered = np.zeros(len(group), bool)
            for left, right in pairs_of(group, pairs_at_once):
                fits = ~split[left] | (chunk[left] != chunk[right])
                left, right = left[fits], right[fits]
                near = np.bitwise_count(code[left] ^ code[right]).sum(1, dtype=np.int64) <= radius
                partnered[left[near]] = True
                partnered[right[near]] = True
            if partnered.any():
                kept = rows.select(["group", "table", "node", "chunk", "split"]).filter(pa.array(partnered))
                yield from kept.combine_chunks().to_batches()

    return retrieve


def _rerank(codes: Codes, threshold: float, pairs_at_once: int = 1 << 16):
    """From (group, table, node, chunk, split, copies, vector): links per node (kind 0) and stars (kind 1)."""

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            group, table, node, chunk = (rows[name].to_numpy() for name in ("group", "table", "node", "chunk"))
            split, copies = rows["split"].to_numpy(), rows["copies"].to_numpy()
            values = rows["vector"].combine_chunks().flatten().to_numpy().astype(float)
            vectors = unit(values.reshape(len(group), -1))
            keys = codes.keys(vectors)
            linked = np.zeros(len(group), np.int64)
            a, b = [], []
            for left, right in pairs_of(group, pairs_at_once):
                fits = ~split[left] | (chunk[left] != chunk[right])
                left, right = left[fits], right[fits]
                earlier = (keys[left] == keys[right]) & (np.arange(codes.tables) < table[left][:, None])
                first = ~earlier.any(1)
                left, right = left[first], right[first]
                close = np.einsum("ij,ij->i", vectors[left], vectors[right]) >= threshold
                left, right = left[close], right[close]
                np.add.at(linked, left, copies[right])
                np.add.at(linked, right, copies[left])
                if len(left):
                    high, low = stars(node[left], node[right])
                    a.append(high)
                    b.append(low)
            hit = linked > 0
            kind = np.concatenate([np.zeros(hit.sum(), np.int32), np.ones(sum(map(len, a)), np.int32)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind), pa.array(np.concatenate([node[hit], *a])), pa.array(np.concatenate([linked[hit], *b]))],
                names=["kind", "a", "b"],
            )

    return rerank


def _tables(codes: Codes):
    """From (node, vector): one row per table with the bucket and the whole code."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = codes.table_bits * codes.tables
        padding = -width % 64 if width else 64
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                values = part.column(1).flatten().to_numpy().astype(float).reshape(part.num_rows, -1)
                keys = codes.keys(values)
                bits = (keys[:, :, None] >> np.arange(codes.table_bits) & 1).astype(np.uint8).reshape(len(keys), width)
                bits = np.pad(bits, ((0, 0), (0, padding)))
                code = [row.tobytes() for row in np.packbits(bits, axis=1, bitorder="little")]
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(codes.tables, dtype=np.int32), n)),
                        pa.array(keys.reshape(-1)),
                        pa.array(np.repeat(part.column(0).to_numpy(), codes.tables)),
                        pa.array(code, pa.binary()).take(pa.array(np.repeat(np.arange(n), codes.tables))),
                    ],
                    names=["table", "bucket", "node", "code"],
                )

    return send


def _met(nodes: DataFrame, codes: Codes, chunk_rows: int) -> DataFrame:
    """`group`, `table`, `node`, `chunk`, `split` of the rows that have a partner in their bucket."""
    sent = stored(nodes.select("node", "vector").mapInArrow(_tables(codes), "table int, bucket long, node long, code binary"), "codes")
    sizes = sent.groupBy("table", "bucket").count().where("count > 1")
    sizes = sizes.select("table", "bucket", F.ceil(F.col("count") / chunk_rows).cast("int").alias("chunks"))
    dealt = sent.join(sizes, ["table", "bucket"])
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    block = [F.least("chunk", "other"), F.greatest("chunk", "other")]
    # Hashes of 64 bits name the groups: two that collide would only be compared in one task in vain.
    dealt = dealt.select(
        F.xxhash64("table", "bucket", *block).alias("group"),
        "table",
        "node",
        "chunk",
        (F.col("chunk") != F.col("other")).alias("split"),
        "code",
    )
    ordered = dealt.repartition("group").sortWithinPartitions("group")
    kept = ordered.mapInArrow(_partners(codes.radius), "group long, table int, node long, chunk int, split boolean")
    return stored(kept, "partners")


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    miss: float = 0.002,
    sample_rows: int = 10_000,
    chunk_rows: int = 4096,
) -> DataFrame:
    """`key`, `n_links`, `component` (smallest key reachable) of every vector.

    The rotations are fitted on at most `sample_rows` vectors, those with the smallest hash.
    """
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = stored(rows.withColumn("dimension", F.when(F.col("usable"), F.size("vector"))), "vectors")
    grouped = rows.where("usable").groupBy("vector", "dimension")
    nodes = grouped.agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    # Vectors of different dimension have no cosine, so each dimension is a space of its own.
    found = None
    for space in nodes.groupBy("dimension").count().orderBy("dimension").collect():
        part = nodes.where(F.col("dimension") == space["dimension"])
        sample = part.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample_rows).collect()
        codes = learn(np.array([r["vector"] for r in sample]), space["count"], threshold, miss)
        met = _met(part, codes, chunk_rows)
        joined = met.join(part.select("node", "copies", "vector"), "node")
        joined = joined.select("group", "table", "node", "chunk", "split", "copies", "vector")
        ordered = joined.repartition("group").sortWithinPartitions("group")
        close = ordered.mapInArrow(_rerank(codes, threshold), "kind int, a long, b long")
        found = close if found is None else found.union(close)
    if found is None:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component"))
    found = stored(found, "links")
    links = found.where("kind = 0").groupBy("a").agg(F.sum("b").alias("links")).withColumnRenamed("a", "node")
    classes = components(found.where("kind = 1").select("a", "b"))
    named = nodes.select("vector", "node", "least", "copies").join(links, "node", "left").join(classes, "node", "left")
    named = named.withColumn("class", F.coalesce("component", "node"))
    smallest = named.where("links > 0").groupBy("class").agg(F.min("least").alias("smallest"))
    named = named.join(smallest, "class", "left").select(
        "vector",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("smallest", "least").alias("component"),
    )
    joined = rows.join(named, (rows["vector"] == named["vector"]) & rows["usable"], "left")
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("usable"), F.col("component")).otherwise(F.col("key")).alias("component"),
    )
