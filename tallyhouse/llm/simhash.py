"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints of 64 bits that differ in at most t = 4 bits differ in at most one bit of one of three blocks (21, 21
and 22 bits).  Each block is covered by the code "Hamming [15, 11] on its first 15 bits, every word on the rest": a
perfect code of covering radius R = 1, so each block value has exactly one home anchor within R.  If x has home
anchor a and y differs from x in one bit, then y is within R + 1 of a.  So each fingerprint goes to its home anchor
and to all anchors within covering radius plus threshold (7 or 14 more for each block), and is compared there
with the fingerprints whose home the anchor is.  That finds every pair within t; nothing is missed.

Documents with equal fingerprints are one node from the start, so groups of copies cost one row.  Anchors that are
home to very many distinct fingerprints are cut into chunks of homes, each chunk in a task of its own.  A task holds
one chunk of homes and streams the rest past it; it gives back stars, not pairs.

Edge cases: a null or empty text has fingerprint zero and is linked like any other; with fewer words than a shingle
the whole sequence is the shingle; repeated rows keep their number; a null key takes part and is not chosen as a class's
smallest key unless all are null; an empty table gives an empty table; other input columns are ignored whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.components import components, stars
from tallyhouse.llm.texts import whole
from tallyhouse.sources.scratch import stored

#: First bit and width of each block.
BLOCKS = ((0, 21), (21, 21), (42, 22))
_CODED = 15  # bits of a block under the Hamming code; the rest are taken as they are


def fingerprint(text: str, shingle: int, seed: int, chunk: int = 1 << 16) -> int:
    """Bits set in over half of the hashes of the word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    found = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(word) + 1 for word in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - shingle + 1)
    spans = list(zip(starts[:n].tolist(), ends[len(found) - n :].tolist(), strict=True))
    ones = np.zeros(64, np.int64)
    for at in range(0, n, chunk):
        hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in spans[at : at + chunk]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int, seed: int) -> DataFrame:
    """`key` and `print` (the fingerprint's 64 bits as a signed long) of every document."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x.as_py(), shingle, seed) for x in batch.column(1)], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["key", "print"])

    texts = docs.select(F.col(key).alias("key"), whole(text).alias("text"))
    return texts.mapInArrow(compute, T.StructType([texts.schema["key"], T.StructField("print", T.LongType())]))


@lru_cache(maxsize=1)
def _anchors() -> tuple[np.ndarray, np.ndarray]:
    """For each 15-bit value: its home codeword, and up to seven more codewords at distance two (-1: none).

    A 15-bit value's syndrome is the XOR of the positions (1 to 15) of its set bits; the codewords have syndrome 0.
    """
    values = np.arange(1 << _CODED)
    syndrome = np.zeros_like(values)
    for bit in range(_CODED):
        syndrome ^= np.where(values >> bit & 1, bit + 1, 0)
    home = values ^ np.where(syndrome, 1 << np.maximum(syndrome - 1, 0), 0)
    more = np.full((len(values), 7), -1)
    filled = np.zeros(len(values), int)
    for one in range(1, _CODED + 1):
        other = syndrome ^ one
        fits = (syndrome != 0) & (other > one) & (other <= _CODED)
        rows = np.flatnonzero(fits)
        more[rows, filled[rows]] = values[rows] ^ (1 << (one - 1)) ^ (1 << (other[rows] - 1))
        filled[rows] += 1
    return home, more


def anchored(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, anchor and whether it is the home, for every anchor that a fingerprint is sent to."""
    home, more = _anchors()
    rows, anchors, homes = [], [], []
    each = np.arange(len(prints))
    for number, (first, width) in enumerate(BLOCKS):
        block = (prints >> np.uint64(first)).astype(np.int64) & ((1 << width) - 1)
        coded, rest = block & ((1 << _CODED) - 1), block >> _CODED << _CODED
        tag = number << 32
        own = home[coded]
        rows.append(each)
        anchors.append(tag | rest | own)
        homes.append(np.ones(len(prints), bool))
        for bit in range(_CODED, width):
            rows.append(each)
            anchors.append(tag | (rest ^ (1 << bit)) | own)
            homes.append(np.zeros(len(prints), bool))
        near = more[coded]
        row, column = np.nonzero(near >= 0)
        rows.append(row)
        anchors.append(tag | rest[row] | near[row, column])
        homes.append(np.zeros(len(row), bool))
    return np.concatenate(rows), np.concatenate(anchors), np.concatenate(homes)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 5000):
            prints = batch.column(0).slice(at, 5000).to_numpy(zero_copy_only=False).astype("<i8")
            rows, anchors, homes = anchored(prints.view("<u8"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(homes), pa.array(prints[rows])], names=["anchor", "home", "print"]
            )


def _compare(max_bits: int, pairs_at_once: int = 1 << 21):
    """Links from rows sorted by anchor, chunk, homes first; a chunk's homes fit in memory, its guests stream by."""

    def found(group: np.ndarray, home: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        owner = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]).astype(int)]))
        homes = np.add.reduceat(home.astype(np.int64), starts)  # homes come first, so they are a prefix
        work = homes[owner]
        guests = np.flatnonzero(work)
        total = np.cumsum(work[guests])
        at = 0
        while at < len(guests):
            upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + pairs_at_once)))
            part = guests[at:upto]
            left = np.repeat(part, work[part])
            skip = np.repeat(np.cumsum(work[part]) - work[part], work[part])
            right = starts[owner[left]] + np.arange(len(left)) - skip
            x, y = prints[left], prints[right]
            near = (x != y) & (np.bitwise_count(x ^ y) <= max_bits)
            if near.any():
                high, low = stars(x[near].view("<i8"), y[near].view("<i8"))
                yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], names=["a", "b"])
            at = upto

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # homes of the group that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column(0).to_numpy()
            chunk = batch.column(1).to_numpy()
            home = batch.column(2).to_numpy(zero_copy_only=False)
            prints = batch.column(3).to_numpy().view("<u8")
            new = len(anchor) - 1
            if held is not None:
                n = len(held[0])
                anchor, chunk, prints = (
                    np.concatenate([h, x]) for h, x in zip(held, (anchor, chunk, prints), strict=True)
                )
                home = np.concatenate([np.ones(n, bool), home])
                new += n
            change = np.concatenate([[0], ((anchor[1:] != anchor[:-1]) | (chunk[1:] != chunk[:-1])).astype(int)])
            group = np.cumsum(change)
            yield from found(group, home, prints)
            keep = (group == group[new]) & home
            held = (anchor[keep], chunk[keep], prints[keep])

    return compare


def links(prints: DataFrame, max_bits: int, homes_a_chunk: int = 4096) -> DataFrame:
    """Links `a`, `b` that connect all distinct fingerprints within `max_bits` bits of each other."""
    if max_bits >= 2 * len(BLOCKS):
        raise ValueError(f"{len(BLOCKS)} blocks find pairs of up to {2 * len(BLOCKS) - 1} differing bits")
    sent = stored(prints.mapInArrow(_replicate, "anchor long, home boolean, print long"), "anchored")
    crowded = sent.where("home").groupBy("anchor").count().where(F.col("count") > homes_a_chunk)
    crowded = crowded.select("anchor", F.ceil(F.col("count") / homes_a_chunk).cast("int").alias("chunks"))
    dealt = sent.join(crowded, "anchor", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("print"), F.col("chunks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    dealt = dealt.select("anchor", "chunk", (F.col("home") & (F.col("own") == F.col("chunk"))).alias("home"), "print")
    ordered = dealt.repartition("anchor", "chunk").sortWithinPartitions("anchor", "chunk", F.desc("home"))
    return ordered.mapInArrow(_compare(max_bits), "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4, seed: int = 42
) -> DataFrame:
    """Key, `fingerprint` (16 hex digits) and `component` (smallest key reachable) of every document."""
    prints = stored(fingerprints(docs, key, text, shingle, seed), "prints")
    nodes = prints.groupBy("print").agg(F.min("key").alias("least"))
    found = stored(components(links(nodes.select("print"), max_bits)), "classes")
    # Class of every node: linked ones by their component, the others by themselves.
    classes = nodes.join(found, nodes["print"] == found["node"], "left")
    classes = classes.select("print", "least", F.coalesce("component", "print").alias("class"))
    linked = found.select(F.col("component").alias("class")).distinct()
    merged = classes.join(linked, "class", "left_semi").groupBy("class").agg(F.min("least").alias("smallest"))
    named = classes.join(merged, "class", "left").select("print", F.coalesce("smallest", "least").alias("component"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return prints.join(named, "print").select(F.col("key").alias(key), digits.alias("fingerprint"), "component")
