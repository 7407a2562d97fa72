import zlib

import numpy as np
import pandas as pd

from tallyhouse.llm import toxicity
from tallyhouse.llm.queries import op9_toxicity

FOLDER = "/root/testdata/sf0.1"


def terms(text):
    return np.array(sorted({c for w in toxicity.words_of(text) for c in toxicity.columns_of(w)}), "<u4")


def test_held_out_accuracy():
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"])
    rows = docs.merge(pd.read_parquet(f"{FOLDER}/labels.parquet"), on="doc_id")
    held = np.array([zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id])
    model = toxicity.train([terms(t) for t in rows.text[~held]], rows.toxic[~held].to_numpy())
    score = model.scorer()
    said = np.array([score(t) >= 0.3 for t in rows.text[held]])
    toxic = rows.toxic[held].to_numpy() > 0
    assert (said & toxic).sum() >= 0.85 * toxic.sum()
    assert (said & toxic).sum() >= 0.93 * said.sum()


def test_scorer_equals_the_definition():
    rng = np.random.default_rng(0)
    columns = np.array(sorted({c for w in ("idiots", "group", "fine") for c in toxicity.columns_of(w)}))
    model = toxicity.Model(-1.0, columns, rng.normal(size=len(columns)), rng.normal(size=(len(columns), 3)))
    text = "Idiots! of the GROUP, idiots"
    own = sorted(set(terms(text).tolist()) & set(columns.tolist()))
    at = [columns.tolist().index(c) for c in own]
    pairs = sum(model.factors[i] @ model.factors[j] for i in at for j in at if i < j)
    margin = -1.0 + model.weights[at].sum() + pairs
    assert np.isclose(model.scorer()(text), 1 / (1 + np.exp(-margin)))


def test_pairs_weigh_more_than_their_parts():
    """Two words that are harmless alone are toxic together: no sum of weights can say that."""
    rng = np.random.default_rng(3)
    first, second, filler = (toxicity.columns_of(w) for w in ("ins", "grp", "foo"))
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array(sorted({*(first if a else ()), *(second if b else ()), *filler}), "<u4"))
        labels.append(int(a == b))
    model = toxicity.train(rows, np.array(labels), epochs=30, factor_rate=0.2, l1_rate=0.001)
    score = model.scorer()
    assert min(score("ins grp foo"), score("foo")) > max(score("ins foo"), score("grp foo"))


def test_pairs_without_weights_of_their_own():
    """Two words that are as often toxic as all others, but always together: found with the defaults, at 12,000 rows."""
    rng = np.random.default_rng(3)
    letters = "abcdefghijklmnopqrst"
    words = ["ins", "grp", *(f"w{a}{b}" for a in letters for b in letters)]
    column = {word: toxicity.columns_of(word)[0] for word in words}
    fillers = list(column.values())[2:]
    rows, labels = [], []
    for _ in range(12_000):
        a, b = rng.random(2) < 0.15
        own = {*rng.choice(fillers, 20).tolist(), *([column["ins"]] if a else ()), *([column["grp"]] if b else ())}
        rows.append(np.array(sorted(own), "<u4"))
        labels.append(int(a and b or not a and not b and rng.random() < 0.15))
    score = toxicity.train(rows, np.array(labels)).scorer()
    assert score("ins grp waa wbb") > 0.9
    assert max(score("ins waa wbb"), score("grp waa wbb"), score("waa wbb")) < 0.2


def test_one_class_and_no_rows():
    empty = toxicity.train([], np.array([]))
    assert empty.scorer()("anything") < 0.3
    assert toxicity.train([terms("a b")] * 5, np.zeros(5)).scorer()("a b") < 0.3


def test_odd_rows(spark, folders):
    rows = op9_toxicity(spark, folders["odd"]).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 4 == 2) for r in rows)
