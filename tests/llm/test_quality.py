import re
from collections import Counter

import numpy as np

from tallyhouse.llm import quality
from tallyhouse.llm.queries import op3_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_statistics(spark, folders):
    texts = [r["text"] for r in spark.read.parquet(f"{folders['odd']}/documents.parquet").collect()]
    texts += ["a b c a b c a", "a a a a", "x y", "a b c d a b c e b c d", "# $ | x\n# $ | x\n\n\n y\n y\ny"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in quality.statistics(table).collect():
        got = tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == plain_statistics(texts[row["key"]])


def test_odd_rows(spark, folders):
    rows = {r["doc_id"]: r for r in op3_quality_rules(spark, folders["odd"]).collect()}
    assert rows[0]["base_failed"] and not rows[0]["kept"] and rows[0]["n_words"] == 0
    assert rows[11]["base_failed"] and rows[11]["n_repeat_words"] == 120
    assert rows[6]["n_words"] == 800 and rows[4]["word_chars"] == 300_000


def test_learns_conjunctions_in_order():
    rng = np.random.default_rng(1)
    rows = {"symbols_a_word": rng.random(4000), "word_length": 10 * rng.random(4000), "words": 1000 * rng.random(4000)}
    bad = (rows["symbols_a_word"] > 0.8) | ((rows["word_length"] < 3) & (rows["words"] > 700))
    rules = quality.learn(rows, bad)
    hit = np.zeros(4000, bool)
    for rule in rules:
        hit |= quality.covered(rule, rows)
    assert (hit & bad).sum() > 0.97 * bad.sum() and (hit & ~bad).sum() < 0.02 * (~bad).sum()


def test_one_class_has_no_rules():
    rows = {"words": np.arange(100.0)}
    assert quality.learn(rows, np.zeros(100, bool)) == []


def test_first_rule_wins(spark):
    rules = [[quality.Condition("words", True, 5.0)], [quality.Condition("words", False, 8.0)]]
    table = spark.createDataFrame([(1.0,), (6.0,), (9.0,)], "words double")
    assert [r[0] for r in table.select(quality.first_rule(rules)).collect()] == [2, 1, 1]
