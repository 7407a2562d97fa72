"""Token ids in compressed binary files: canonical length-limited Huffman codes, decoded by table in independent blocks.

A file set is a folder of three Parquet tables, so that Spark's commit protocol decides which files count when
executors are lost:

* `codebook` (id, length): the code lengths.  Codes are canonical, so lengths are all a reader needs: ids sorted by
  (length, id) get rising codes, most significant bit first.
* `blocks` (part, first, n_ids, is_whole, payload, checkpoints, docs): independent blocks of at most `block_ids` ids.
  `payload` holds the codes, `checkpoints` the bit offset of every `every`-th id (little-endian unsigned 32-bit), `docs`
  what the block holds of which document: its key, where it begins in the part and in the block, how many ids.  A block
  holds whole documents or a piece of one that is longer than a block.
* `parts` (part, n_ids, before): the ids before each part.

Documents lie in ascending order of their key, nulls first; rows of one key in order of the input.  The stream of ids is cut
into parts by ranges of the key, so no task sees more than a range, and a key with very many rows is cut as well.  Code lengths
come from the counts of all ids; the driver gets one row per id of the vocabulary and one per part.  Decoding runs through
all checkpoints of a block at once, one table lookup per id.

Edge cases: a null or empty text is its end id alone; repeated rows are written as documents of their own; an empty table
gives an empty file set; other input columns are ignored whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyhouse.llm.texts import whole
from tallyhouse.sources.scratch import fresh_path, stored

VOCABULARY = "word_bpe_49k.json"

#: The vocabulary drops white space and splits words there, so words between spaces and line feeds are encoded alone.
_GAP = re.compile(r"[ \n]")
#: Letters that stay single letters in lower case and composed form, and marks after them: one run of ids for each.
_MARKS = r"[!#$%&()*+,./:;=?@^_~-]"
_PLAIN = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]+" + _MARKS + "*$"
_KNOWN_WORDS, _KNOWN_BYTES = 400_000, 96


# --- ids of texts -----------------------------------------------------------------------------------------------


class WordEncoder:
    """Ids of texts through the library, each different word of a batch once and frequent words once per process."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Spark already runs one process per core; the library's own threads would compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known, self.known_ids = pa.array([], pa.string()), pa.array([], pa.binary())
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends_word[number] = bool(suffix) and token.endswith(suffix)

    def ids(self, texts: pa.Array, piece_chars: int = 1 << 20) -> pa.BinaryArray:
        """All ids of each whole text (strings without nulls), in `type`."""
        owners = None
        if pc.max(pc.binary_length(texts)).as_py() > piece_chars:  # cut long texts at white space
            pieces, owners = [], []
            for owner, text in enumerate(texts.to_pylist()):
                start = 0
                while len(text) - start > piece_chars and (gap := _GAP.search(text, start + piece_chars)):
                    pieces.append(text[start : gap.start()])
                    owners.append(owner)
                    start = gap.start()
                pieces.append(text[start:])
                owners.append(owner)
            texts = pa.array(pieces, pa.string())
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        # Taking every word's ids by its number among the different words lays them end to end.
        taken = self._words(words.dictionary).take(words.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int32)[taken.offset : taken.offset + len(taken) + 1]
        ends = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        if owners is not None:
            ends = ends[np.searchsorted(owners, np.arange(owners[-1] + 2))]
        return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), taken.buffers()[2]])

    def _words(self, words: pa.StringArray) -> pa.BinaryArray:
        """Ids of different words: those known, and those that this batch is the first to bring."""
        place = pc.index_in(words, self.known).to_numpy(zero_copy_only=False)
        is_new = np.isnan(place) if place.dtype.kind == "f" else np.zeros(len(words), bool)
        places = np.where(is_new, 0, place).astype(np.int64)
        unseen = words.filter(pa.array(is_new))
        is_plain = pc.match_substring_regex(unseen, _PLAIN).to_numpy(zero_copy_only=False)
        if not self.ends_word.any():
            is_plain[:] = False
        fresh, done = self._plain(unseen.filter(pa.array(is_plain)))
        is_plain[np.flatnonzero(is_plain)[~done]] = False
        other = unseen.filter(pa.array(~is_plain)).to_pylist()
        single = []
        for few in range(0, len(other), 1 << 14):
            encoded = self.tokenizer.encode_batch_fast(other[few : few + (1 << 14)], add_special_tokens=False)
            single += [np.asarray(one.ids, self.type).tobytes() for one in encoded]
        found = np.empty(len(unseen), np.int64)
        found[is_plain] = np.flatnonzero(done)
        found[~is_plain] = len(fresh) + np.arange(len(single))
        places[is_new] = len(self.known) + found
        ids = pa.concat_arrays([self.known_ids, fresh, pa.array(single, pa.binary())]).take(pa.array(places))
        short = pc.less_equal(pc.binary_length(words), _KNOWN_BYTES)
        if len(self.known) + len(unseen) > _KNOWN_WORDS:  # keep what this batch holds
            self.known, self.known_ids = words.filter(short), ids.filter(short)
        else:
            keep = pc.and_(short, pa.array(is_new))
            self.known = pa.concat_arrays([self.known, words.filter(keep)])
            self.known_ids = pa.concat_arrays([self.known_ids, ids.filter(keep)])
        return ids

    def _plain(self, words: pa.StringArray, together: int = 256) -> tuple[pa.BinaryArray, np.ndarray]:
        """Ids of words of plain letters and marks, many in one call, and which of them are right.

        Letters and marks each end with an id that ends a word; where their number is not as expected, the words of that
        call are to be encoded one by one.
        """
        n = len(words)
        runs = 1 + pc.match_substring_regex(words, _MARKS + "$").to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.append(np.arange(0, n, together), n)
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words)
        done, sizes, ids = np.ones(n, bool), np.zeros(n, np.int64), []
        joined = pc.binary_join(lists, " ").to_pylist()
        for few in range(0, len(joined), 64):
            encoded = self.tokenizer.encode_batch_fast(joined[few : few + 64], add_special_tokens=False)
            for group, one in enumerate(encoded, few):
                mine = slice(starts[group], starts[group + 1])
                got = np.asarray(one.ids, self.type)
                ends, last = np.flatnonzero(self.ends_word[got]) + 1, np.cumsum(runs[mine])
                if len(ends) == last[-1] and ends[-1] == len(got):
                    sizes[mine] = np.diff(ends[last - 1], prepend=0)
                    ids.append(got)
                else:
                    done[mine] = False
        data = np.concatenate(ids) if ids else np.zeros(0, self.type)
        ends = np.append(0, np.cumsum(sizes * self.type.itemsize)).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]), done


@lru_cache(maxsize=2)
def word_encoder(path: str | None) -> WordEncoder:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return WordEncoder(path)


def id_type(vocabulary: str | None = None) -> np.dtype:
    return word_encoder(vocabulary).type


def token_rows(docs: DataFrame, key: str, text: str, vocabulary: str | None, batch_bytes: int = 1 << 23) -> DataFrame:
    """`key` and the `ids` of every whole text, as little-endian integers of the vocabulary's width."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
            turns = np.cumsum(sizes) // batch_bytes
            starts = np.flatnonzero(np.r_[True, turns[1:] != turns[:-1]]) if len(turns) else []
            for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                rows = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([rows.column(0), encoder.ids(rows.column(1))], names=["key", "ids"])

    texts = docs.select(F.col(key).alias("key"), whole(text).alias("text"))
    return texts.mapInArrow(encode, T.StructType([texts.schema["key"], T.StructField("ids", T.BinaryType())]))


# --- codes ------------------------------------------------------------------------------------------------------


def limited_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Code lengths of an optimal prefix code with no code over `longest` bits (package-merge), for counts above 0."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.uint8)
    if n > 1 << longest:
        raise ValueError(f"{n} ids do not fit codes of {longest} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    packages, levels = np.zeros(0, np.int64), []
    for _ in range(longest):
        both = np.concatenate([leaves, packages])
        by_weight = np.argsort(both, kind="stable")
        levels.append(by_weight < n)
        both = both[by_weight]
        pairs = len(both) // 2 * 2
        packages = both[0:pairs:2] + both[1:pairs:2]
    lengths, taken = np.zeros(n, np.uint8), 2 * n - 2
    for is_leaf in reversed(levels):
        found = int(is_leaf[:taken].sum())
        lengths[:found] += 1
        taken = 2 * (taken - found)
    result = np.zeros(n, np.uint8)
    result[order] = lengths
    return result


@dataclass(frozen=True)
class Codebook:
    """Code lengths by id (0: the id does not occur), and the longest code allowed."""

    lengths: bytes
    longest: int

    def _in_order(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids in order of (length, id), and their lengths."""
        lengths = np.frombuffer(self.lengths, np.uint8)
        ids = np.flatnonzero(lengths)
        ids = ids[np.lexsort((ids, lengths[ids]))]
        return ids, lengths[ids].astype(np.int64)

    def codes(self) -> np.ndarray:
        """By id its canonical code times 32 plus the code's length."""
        ids, lengths = self._in_order()
        codes = np.zeros(len(self.lengths), np.int64)
        # A code's place among all bit strings of the longest length is the sum of the room of those before it.
        room = 1 << (self.longest - lengths)
        codes[ids] = (np.cumsum(room) - room >> (self.longest - lengths) << 5) | lengths
        return codes

    def table(self) -> np.ndarray:
        """For every bit string of the longest length the id it begins with (times 32) and that id's length."""
        ids, lengths = self._in_order()
        found = np.repeat((ids << 5 | lengths).astype(np.uint32), 1 << (self.longest - lengths))
        return np.concatenate([found, np.zeros((1 << self.longest) - len(found), np.uint32)])


def encode_block(ids: np.ndarray, codes: np.ndarray, every: int) -> tuple[bytes, bytes]:
    """Payload and checkpoints of a block; `codes` holds each id's code times 32 plus its length."""
    if not len(ids):
        return b"", b""
    found = codes[ids]
    sizes = found & 31
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = ends - sizes
    words = (starts >> 5).astype(np.int32)
    # Each code in the 64 bits that begin with word number `words`.
    placed = (found >> 5).astype(np.uint64) << (64 - (starts & 31) - sizes).astype(np.uint64)
    first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    packed = np.zeros((int(ends[-1]) + 31 >> 5) + 1, np.uint64)
    # Codes share no bit, so sums are unions; a sum of the lower halves never carries.
    upper = np.add.reduceat(placed >> np.uint64(32), first)
    packed[words[first]] += upper
    packed[words[first] + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), first)
    size = int(ends[-1]) + 7 >> 3
    return packed.astype(">u4").tobytes()[:size], starts[::every].astype("<u4").tobytes()


def decode_block(payload: bytes, checkpoints: bytes, n: int, table: np.ndarray, longest: int, every: int) -> np.ndarray:
    """The ids of a block: all checkpoints advance together, one lookup each per step."""
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
    found = np.empty((every, len(at)), np.uint32)
    mask = np.uint32((1 << longest) - 1)
    for step in range(min(every, n)):
        place = np.minimum(at >> 3, len(window) - 1)  # lanes past the block's end read on harmlessly
        entry = table[(window[place] >> (32 - longest - (at & 7)).astype(np.uint32)) & mask]
        found[step] = entry >> 5
        at += entry & 31
    return found.T.reshape(-1)[:n]


# --- checksums --------------------------------------------------------------------------------------------------


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo the polynomial of crc32; bit 31 is the constant term."""
    product = 0
    while b:
        if b & 0x80000000:
            product ^= a
        b = b << 1 & 0xFFFFFFFF
        a = a >> 1 ^ (0xEDB88320 if a & 1 else 0)
    return product


def joined_crc32(pieces: Iterable[tuple[int, int]]) -> int:
    """The crc32 of joined byte strings, given (crc32, length) of each."""
    total = 0
    for crc, length in pieces:
        power, base, n = 0x80000000, 0x00800000, length  # 1 and x^8
        while n:
            if n & 1:
                power = _times(base, power)
            base, n = _times(base, base), n >> 1
        total = _times(power, total) ^ crc
    return total


# --- file sets --------------------------------------------------------------------------------------------------


def _counts(rows: DataFrame, dtype: np.dtype, end: int) -> dict[int, int]:
    """How often each id occurs, an end id after every row included; at most one row per id of the vocabulary comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(end + 1, np.int64)
        for batch in batches:
            found = np.bincount(_values(batch.column(0), dtype), minlength=len(total))
            found[: len(total)] += total
            total = found
            total[end] += batch.num_rows
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    found = rows.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {row["id"]: row["n"] for row in found.collect()}


def _values(ids: pa.Array, dtype: np.dtype) -> np.ndarray:
    """All values of an array of binary rows without nulls, laid end to end."""
    ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
    return np.frombuffer(ids.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(dtype) if len(ids) else np.zeros(0, dtype)


def write(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    end: int = 2,
    block_ids: int = 1 << 16,
    every: int = 64,
    longest: int = 18,
) -> None:
    """Write the ids of all texts as a file set under `path`."""
    spark = docs.sparkSession
    dtype = id_type(vocabulary)
    rows = stored(token_rows(docs, key, text, vocabulary), "ids")
    counts = _counts(rows, dtype, end)
    ids = np.asarray(sorted(counts), np.int64)
    lengths = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.uint8)
    lengths[ids] = limited_lengths(np.asarray([counts[int(i)] for i in ids], np.int64), longest)
    book = Codebook(lengths.tobytes(), longest)
    listed = [(int(i), int(lengths[i])) for i in ids]
    spark.createDataFrame(listed, "id int, length int").coalesce(1).write.parquet(f"{path}/codebook")

    doc = T.StructType(
        [
            T.StructField("key", rows.schema["key"].dataType),
            T.StructField("begin", T.LongType()),
            T.StructField("at", T.LongType()),
            T.StructField("n", T.LongType()),
        ]
    )
    schema = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("is_whole", T.BooleanType()),
            T.StructField("payload", T.BinaryType()),
            T.StructField("checkpoints", T.BinaryType()),
            T.StructField("docs", T.ArrayType(doc)),
        ]
    )
    keys = pa.struct([("key", to_arrow_type(doc["key"].dataType)), ("begin", pa.int64()), ("at", pa.int64()), ("n", pa.int64())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, last = book.codes(), np.asarray([end], dtype)
        part, first = TaskContext.get().partitionId(), 0
        waiting, held, n = [], [], 0

        def block(ids: np.ndarray, docs_here: list[dict], is_whole: bool) -> pa.RecordBatch:
            payload, checkpoints = encode_block(ids, codes, every)
            columns = [pa.array([x], pa.int64()) for x in (part, first, len(ids))]
            columns += [pa.array([is_whole]), pa.array([payload], pa.binary()), pa.array([checkpoints], pa.binary())]
            return pa.RecordBatch.from_arrays([*columns, pa.array([docs_here], pa.list_(keys))], names=schema.names)

        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(np.frombuffer(value.as_py(), dtype), last)
                if n and n + len(ids) > block_ids:
                    yield block(np.concatenate(waiting), held, True)
                    first, waiting, held, n = first + n, [], [], 0
                if len(ids) <= block_ids:
                    held.append({"key": name.as_py(), "begin": first + n, "at": n, "n": len(ids)})
                    waiting.append(ids)
                    n += len(ids)
                    continue
                begin = first
                for start in range(0, len(ids), block_ids):
                    some = ids[start : start + block_ids]
                    yield block(some, [{"key": name.as_py(), "begin": begin, "at": 0, "n": len(some)}], False)
                    first += len(some)
        if n:
            yield block(np.concatenate(waiting), held, True)

    # Rows of one key are told apart by their place in the stored table, so a hot key is cut into ranges as well.
    placed = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange("key", "place")
    ordered = placed.sortWithinPartitions("key", "place").select("key", "ids")
    ordered.mapInArrow(blocks, schema).write.option("compression", "none").parquet(f"{path}/blocks")
    written = spark.read.schema(schema).parquet(f"{path}/blocks")
    sizes = written.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()  # one row per part, as many as tasks
    before, parts = 0, []
    for size in sorted(sizes, key=lambda row: row["part"]):
        parts.append((size["part"], size["n"], before))
        before += size["n"]
    spark.createDataFrame(parts, "part long, n_ids long, before long").coalesce(1).write.parquet(f"{path}/parts")


def read(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False, every: int = 64, longest: int = 18) -> DataFrame:
    """Per document of a file set: key, `start`, `n_tokens`, `ids_crc32`, on request its `ids` (array)."""
    listed = spark.read.schema("id int, length int").parquet(f"{path}/codebook").collect()  # one row per id of the vocabulary
    lengths = np.zeros(max((row["id"] for row in listed), default=-1) + 1, np.uint8)
    for row in listed:
        lengths[row["id"]] = row["length"]
    book = Codebook(lengths.tobytes(), longest)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["docs"].dataType.elementType["key"]
    fields = [kind, *[T.StructField(name, T.LongType()) for name in ("part", "begin", "at", "n", "crc")]]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = book.table()
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, n, payload, checkpoints = (batch.column(i)[row].as_py() for i in range(5))
                ids = decode_block(payload, checkpoints, n, table, longest, every).astype("<u4")
                held = batch.column(5).slice(row, 1).flatten()
                at, sizes = held.field("at").to_numpy(), held.field("n").to_numpy()
                pieces = [ids[a : a + m].tobytes() for a, m in zip(at.tolist(), sizes.tolist(), strict=True)]
                columns = [held.field("key"), pa.array(np.full(len(at), part)), held.field("begin"), pa.array(first + at)]
                columns += [held.field("n"), pa.array([zlib.crc32(piece) for piece in pieces], pa.int64())]
                if with_ids:
                    columns.append(pa.array(pieces, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[field.name for field in fields])

    @F.pandas_udf(T.LongType())
    def joined(pieces: pd.Series) -> pd.Series:
        return pieces.map(lambda some: joined_crc32((p["crc"], 4 * p["n"]) for p in some))

    schema = T.StructType(fields)
    blocks = blocks.select("is_whole", "part", "first", "n_ids", "payload", "checkpoints", "docs")
    whole_docs = blocks.where("is_whole").drop("is_whole").mapInArrow(decode, schema)
    whole_docs = whole_docs.withColumnsRenamed({"n": "n_tokens", "crc": "ids_crc32"})
    # A document over a block's size comes in as many pieces as blocks that hold it.
    pieces = blocks.where("not is_whole").drop("is_whole").mapInArrow(decode, schema)
    held = F.sort_array(F.collect_list(F.struct("at", "n", "crc", *(["ids"] if with_ids else []))))
    cut = pieces.groupBy("part", "begin").agg(F.first("key").alias("key"), F.sum("n").alias("n_tokens"), held.alias("pieces"))
    cut = cut.withColumn("ids_crc32", joined(F.transform("pieces", lambda p: F.struct(p["n"].alias("n"), p["crc"].alias("crc")))))
    if with_ids:
        cut = cut.withColumn("ids", F.aggregate("pieces", F.lit(b""), lambda done, p: F.concat(done, p["ids"])))
    columns = ["key", "part", "begin", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    parts = spark.read.schema("part long, n_ids long, before long").parquet(f"{path}/parts").select("part", "before")
    # Proven bound of the broadcast: one row per part, as many as the writing job had tasks.
    both = whole_docs.select(columns).unionByName(cut.select(columns)).join(F.broadcast(parts), "part")
    result = [F.col("key").alias(key), (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"]
    if with_ids:
        result.append(_unpacked("ids").alias("ids"))
    return both.select(result)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _unpacked(ids: pd.Series) -> pd.Series:
    return ids.map(lambda some: np.frombuffer(some, "<u4").astype(np.int64))


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write a file set in the shared folder and read every document back."""
    path = fresh_path(docs.sparkSession, "token-ids")
    write(docs, path, **options)
    return read(docs.sparkSession, path, options.get("key", "doc_id"))
