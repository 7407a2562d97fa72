import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyhouse.llm import packing


def placed(plan):
    """(length, number) → (sequence, offset)."""
    found = {}
    for length, first, last, sequence, each, offset in plan.runs:
        for number in range(first, last):
            assert (length, number) not in found
            found[length, number] = (sequence + (number - first) // each, offset + (number - first) % each * length)
    return found


def fewest(lengths, capacity):
    """The least number of sequences, by search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def search(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for i in {room: i for i, room in enumerate(rooms)}.values():
            if rooms[i] >= lengths[at]:
                search(at + 1, rooms[:i] + [rooms[i] - lengths[at]] + rooms[i + 1 :])
        search(at + 1, [*rooms, capacity - lengths[at]])

    search(0, [])
    return best


def test_places_are_gapless_and_whole():
    for seed in range(200):
        rng = random.Random(seed)
        capacity = rng.choice([10, 20, 64])
        histogram = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(0, 12))}
        plan = packing.solve(dict(histogram), capacity)
        found = placed(plan)
        assert {(n, i) for n, c in histogram.items() for i in range(c)} == set(found)
        ends = {}
        for (length, _), (sequence, offset) in sorted(found.items(), key=lambda x: x[1]):
            assert offset == ends.get(sequence, 0)
            ends[sequence] = offset + length
        assert sorted(ends) == list(range(plan.sequences)) and all(end <= capacity for end in ends.values())


def test_reduction_keeps_the_optimum():
    for seed in range(150):
        rng = random.Random(seed)
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        plan = packing.Plan({n: lengths.count(n) for n in set(lengths)}, 20)
        packing.reduce_dominated(plan)
        rest = [n for n, count in enumerate(plan.left) for _ in range(count)]
        assert plan.sequences + fewest(rest, 20) == fewest(lengths, 20)


def test_many_documents_come_close_to_the_bound():
    lengths = np.clip(np.random.default_rng(1).lognormal(6.4, 0.9, 100_000).astype(int), 1, 2048)
    sizes, counts = np.unique(lengths, return_counts=True)
    plan = packing.solve(dict(zip(sizes.tolist(), counts.tolist(), strict=True)), 2048)
    assert plan.sequences <= 1.002 * lengths.sum() / 2048


def test_cuts():
    assert packing.cuts(1, 4) == [(0, 1)]
    assert packing.cuts(4, 4) == [(0, 4)]
    assert packing.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_round_trip(spark, folders):
    docs = spark.read.parquet(f"{folders['odd']}/documents.parquet").where("doc_id is not null")
    packed = packing.pack_documents(docs, capacity=512, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    pieces = {}
    for row in packed:
        assert len(row["ids"]) == row["length"] <= 512
        assert zlib.crc32(np.array(row["ids"], "<u4").tobytes()) == row["ids_crc32"]
        pieces.setdefault(row["doc_id"], {})[row["piece"]] = row["ids"]
    for doc_id, text in texts.items():
        ids = [i for piece in sorted(pieces[doc_id]) for i in pieces[doc_id][piece]]
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    assert sum(r["doc_id"] == 6 and r["piece"] == 0 for r in packed) == 2
    joined = packing.sequences(spark.createDataFrame(packed)).collect()
    assert sum(len(r["ids"]) for r in joined) == sum(r["length"] for r in packed)
    assert max(len(r["ids"]) for r in joined) <= 512
