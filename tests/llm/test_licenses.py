import re

import pytest

from tallyhouse.llm import licenses

FOLDER = "/root/testdata/sf0.01"


def plain_scan(text, template):
    """Largest containment of a template in any window of the text that is twice as long as the template."""
    found = [w for w in (re.sub(r"^[\W_]+|[\W_]+$", "", w).lower() for w in (text or "").split()) if w]
    shingles = [" ".join(found[i : i + 5]) for i in range(len(found) - 4)]
    own = set(template.shingles)
    n = 2 * len(own)
    windows = range(max(1, len(shingles) - n + 1))
    return max((len(own & set(shingles[i : i + n])) / len(own) for i in windows), default=0.0)


@pytest.fixture(scope="module")
def templates():
    return [licenses.Template(name, text) for name, text in licenses.NOTICES.items()]


def test_documents_against_brute_force(spark, templates):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(docs).collect()}
    hinted = [r for r in docs.collect() if re.search(licenses.ANCHORS, r["text"])]
    want = {(r["doc_id"], t.name) for r in hinted for t in templates if plain_scan(r["text"], t) >= 0.8}
    assert got == want and len(got) > 30


def test_notices_in_prose_and_with_changes(spark, templates):
    notice = licenses.NOTICES["MIT-permission"]
    changed = notice.replace("any person", "ANY other person")
    rows = [(1, f"foo bar {notice} baz"), (2, f"foo {changed} bar"), (3, notice[: len(notice) // 2]), (4, None), (5, ""),
            (6, "the license"), (7, "copyright " + "word " * 20_000)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["license"]) for r in found} == {(1, "MIT-permission"), (2, "MIT-permission")}
    exact = {r["doc_id"]: r["containment"] for r in found}
    assert exact[1] == 1.0 and exact[2] == plain_scan(rows[1][1], next(t for t in templates if t.name == "MIT-permission"))


def test_retrieval_probability(templates):
    """Windows that hold 80 % of a template share one of the bands nearly always."""
    import random

    template = max(templates, key=lambda t: len(t.shingles))
    own = template.hashes()
    signature = [min(licenses.band_hash(v, b) for v in own) for b in range(licenses.BANDS)]
    rng = random.Random(1)
    met = 0
    for _ in range(300):
        kept = rng.sample(own, round(0.8 * len(own)))
        window = kept + [rng.getrandbits(63) for _ in range(len(own) - len(kept))]
        met += any(min(licenses.band_hash(v, b) for v in window) == signature[b] for b in range(licenses.BANDS))
    assert met >= 297


def test_templates_need_anchor_words():
    with pytest.raises(ValueError):
        licenses.Template("plain", "nothing here that a notice would say at all in any way")
