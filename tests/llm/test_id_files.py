"""Token files against the library's ids of whole texts."""

import functools
import heapq
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tallyhouse.llm import id_files
from tallyhouse.llm.queries import QUERIES, table
from tallyhouse.sources.scratch import fresh_path


@functools.cache
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def library_ids(text):
    return library().encode(text, add_special_tokens=False).ids


def huffman_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def test_lengths_are_optimal():
    for seed in range(60):
        rng = random.Random(seed)
        counts = np.asarray([rng.choice([1, 1, 2, 5, 40, 900]) for _ in range(rng.randint(2, 6))])
        free = id_files.limited_lengths(counts, 12)
        assert int((free * counts).sum()) == huffman_cost(counts.tolist())
        for longest in (3, 4):
            found = id_files.limited_lengths(counts, longest)
            assert found.max() <= longest and sum(0.5 ** int(n) for n in found) <= 1
            best = min(
                sum(a * b for a, b in zip(lengths, counts.tolist(), strict=True))
                for lengths in itertools.product(range(1, longest + 1), repeat=len(counts))
                if sum(0.5**n for n in lengths) <= 1
            )
            assert int((found * counts).sum()) == best


def test_blocks_round_trip():
    for seed, n, kinds in ((1, 0, 1), (2, 1, 1), (3, 64, 3), (4, 65, 300), (5, 9000, 4000), (6, 5000, 2)):
        ids = np.random.default_rng(seed).zipf(1.3, n) % kinds + 7
        found, counts = np.unique(ids, return_counts=True)
        lengths = np.zeros(int(found.max()) + 1 if n else 0, np.uint8)
        lengths[found] = id_files.limited_lengths(counts, 13)
        book = id_files.Codebook(lengths.tobytes(), 13)
        payload, checkpoints = id_files.encode_block(ids, book.codes(), 64)
        assert len(payload) == (int(lengths[ids].sum()) + 7) // 8 and len(checkpoints) == 4 * ((n + 63) // 64)
        back = id_files.decode_block(payload, checkpoints, n, book.table(), 13, 64)
        assert back.tolist() == ids.tolist()


def test_joined_checksums():
    parts = [b"", b"abc", bytes(1000), b"\x01\x02\x03\x04" * 777, b"", b"z"]
    assert id_files.joined_crc32((zlib.crc32(p), len(p)) for p in parts) == zlib.crc32(b"".join(parts))


def test_words_alone_equal_whole_texts(spark, odd_documents):
    rng = random.Random(3)
    alphabet = "aB'st \n\t\r\x0b\x0c\x1c\x1d\x85\xa0 　é̈Σσς9٣!<|>_-\U0001f600İßﬁ漢"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(3000)]
    texts += ["a<|endoftext|> b<|startoftext|>c", "<|endoftext|>", " <|end oftext|>", "I'S it'LL 'm", "x" * 5000]
    texts += [row[1] or "" for row in odd_documents]
    texts += [row["text"] or "" for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts.append(" ".join(a + chr(i) + b for i in range(0x41, 0x250) for a in ("", "a", "e") for b in ("", "n", "Z")))
    texts.append(" ".join(w + t for w in ("ab", "É", "x'") for a in "!#$%&()*+,./:;=?@^_~-'<|" for b in "!.-'a9<" for t in (a, a + b, a + a + b)))
    encoder = id_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for start in (0, 7):  # the second time words are known, and the rows are a slice
        found = encoder.ids(pa.array(texts).slice(start), piece_chars=50 if start else 10**6).to_pylist()
        for ids, whole in zip(found, tokenizer.encode_batch(texts[start:], add_special_tokens=False), strict=True):
            assert np.frombuffer(ids, encoder.type).tolist() == whole.ids
    assert encoder.ids(pa.array([""])).to_pylist() == [b""]


def expected(rows):
    start, found = 0, []
    for key, text in rows:
        ids = [*library_ids(text or ""), 2]
        found.append((key, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_query_against_the_library(spark):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    found = QUERIES["op13_token_id_files"](spark, folder).orderBy("doc_id").collect()
    assert [tuple(row) for row in found] == expected(docs)


def test_small_blocks_and_repeated_keys(spark, frame):
    rng = random.Random(5)
    words = "the a of and to in is you that it <|endoftext|> été 漢字 !!".split()
    rows = [(rng.choice([None, *range(6)]), " ".join(rng.choices(words, k=rng.choice([0, 3, 40, 700])))) for _ in range(60)]
    path = fresh_path(spark, "token-test")
    id_files.write(frame(rows, "doc_id long, text string").repartition(3), path, block_ids=100)
    found = id_files.read(spark, path, with_ids=True).orderBy("start").collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, tuple(r["ids"])) for r in found) == sorted(
        (i is not None, i or 0, (*library_ids(t), 2)) for i, t in rows
    )
    start = 0
    for row in found:
        assert (row["start"], row["n_tokens"]) == (start, len(row["ids"]))
        assert row["ids_crc32"] == zlib.crc32(np.asarray(row["ids"], "<u4").tobytes())
        start += row["n_tokens"]
    keys = [(r["doc_id"] is not None, r["doc_id"]) for r in found]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1] or 0))
