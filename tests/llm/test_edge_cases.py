"""Every query of the package, and the pipeline, on odd rows and on empty tables."""

import pytest

import corpus_pipeline
from tallyhouse.llm.queries import QUERIES, table

PER_ROW = {"op1_token_counts": "documents", "op2_embedding_near_duplicates": "embeddings", "op3_quality_rules": "documents",
           "op4_mix_sources": "documents", "op5_html_main_text": "pages", "op8_simhash_near_duplicates": "documents",
           "op9_toxicity": "documents", "op13_token_id_files": "documents"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, folders, name):
    assert QUERIES[name](spark, folders["empty"]).count() == 0


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_for_each_row(spark, folders, name):
    rows = QUERIES[name](spark, folders["odd"]).collect()
    assert len(rows) == table(spark, folders["odd"], PER_ROW[name]).count()


def test_one_row_for_each_conversation(spark, folders):
    found = [r["conv_id"] for r in QUERIES["op11_conversation_repair"](spark, folders["odd"]).collect()]
    assert sorted(found, key=str) == sorted([0, 1, 2, 3, None], key=str)


def test_anchors_with_odd_vectors(spark, folders):
    found = QUERIES["op12_hard_negatives"](spark, folders["odd"])
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert found.count() == 0  # the only row divisible by 50 has no vector


def test_empty_pipeline(spark, folders):
    assert corpus_pipeline.run(spark, folders["empty"]).count() == 0


def test_pipeline_stages(spark, folders, odd_documents):
    docs, sizes = table(spark, folders["odd"], "documents"), []
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folders["odd"])
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append({(r["doc_id"], r["text"]) for r in docs.collect()})
    clean, single, redacted, mixed = sizes
    given = {(r[0], r[1]) for r in odd_documents}
    # No toxic label reaches a rule here, so nothing is lost; copies of a text leave one document.
    assert clean == given
    assert {(0, None), (3, "a b c"), (4, "x" * 300_000)} <= single
    assert (1, "") not in single and (None, None) not in single  # fingerprint zero, as document 0 has it
    assert not any("24be64439e3e" in (text or "") for _, text in redacted)
    assert {i for i, _ in redacted} == {i for i, _ in single} and len(redacted) == len(single)
    assert mixed <= redacted
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folders["odd"]).collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in mixed}


def test_repeated_ids_keep_their_different_texts(spark, folders):
    docs = table(spark, folders["odd"], "documents").where("doc_id = 3").drop("doc_id")
    other = docs.selectExpr("3L AS doc_id", "'quite another text than the first one' AS text", "lang", "source", "n_chars")
    first = docs.selectExpr("3L AS doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.drop_near_duplicates(spark, first.union(other).union(first), folders["odd"])
    assert sorted(r["text"] for r in kept.collect()) == ["a b c", "quite another text than the first one"]
