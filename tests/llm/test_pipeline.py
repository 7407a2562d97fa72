"""The pipeline on the smallest sample, stage by stage against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyhouse.llm import simhash
from tallyhouse.llm.queries import toxic_model
from tallyhouse.sources.scratch import stored

FOLDER = "/root/testdata/sf0.001"
SECRET = re.compile(r'(?<=token = ")[0-9a-f]{40}(?=")|AKIA[A-Z0-9]{16}|(?<=password=)[0-9a-f]{18}')


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), name)
        found.append(docs)
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_toxic_documents_go(spark, stages):
    score = toxic_model(spark, stages[0], FOLDER).scorer()
    assert texts(stages[1]) == {i: t for i, t in texts(stages[0]).items() if score(t) < 0.3}


def test_one_document_of_each_class_stays(stages):
    given = texts(stages[1])
    prints = {i: simhash.fingerprint(t, 4, 42) for i, t in given.items()}
    classes = {i: i for i in given}
    for a in sorted(given):
        for b in sorted(given):
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4 and classes[a] != classes[b]:
                low, high = sorted((classes[a], classes[b]))
                classes = {i: low if c == high else c for i, c in classes.items()}
    assert texts(stages[2]) == {i: t for i, t in given.items() if classes[i] == i}


def test_secrets_are_replaced(stages):
    want = {i: SECRET.sub("[SECRET]", t) for i, t in texts(stages[2]).items()}
    assert texts(stages[3]) == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3].collect())


def test_mix(stages):
    rows = stages[3].collect()
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows}
    totals = Counter()
    for r in rows:
        totals[r["source"]] += size[r["doc_id"]]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(totals))}
    full = set()
    while True:
        level = (1.5 * sum(totals.values()) - sum(2 * totals[s] for s in full)) / sum(w for s, w in weights.items() if s not in full)
        more = {s for s in totals if s not in full and weights[s] * level >= 2 * totals[s]}
        if not more:
            break
        full |= more
    want = Counter()
    for r in rows:
        s = r["source"]
        rate = 2.0 if s in full else weights[s] * level / totals[s]
        draw = int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        want[r["doc_id"]] = int(rate) + (draw < rate - int(rate))
    assert Counter(r["doc_id"] for r in stages[4].collect()) == +want


def test_packing(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in texts(stages[4]).items()}
    want = Counter()
    for doc_id, n in Counter(r["doc_id"] for r in stages[4].collect()).items():
        total = len(ids[doc_id])
        first = total % 2048 or 2048
        starts = [0, *range(first, total, 2048)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], total], strict=True)):
            want[doc_id, piece, a, b - a, zlib.crc32(ids[doc_id][a:b].tobytes())] += n
    rows = stages[5].collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    same = corpus_pipeline.run(spark, FOLDER).groupBy(*columns).agg(F.count("*"))
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, stages[5].groupBy(*columns).agg(F.count("*")).collect()))
