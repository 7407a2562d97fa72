"""A corpus pipeline: toxicity, near-duplicates, secrets, source mix, packing.

Each stage gets the documents that its predecessor kept and decides on all of them.  Its result is written to the shared folder
and read again, so a lost executor repeats one stage's tasks at most.  All stages but the last return the columns that
they got; null texts are kept as empty ones would be; repeated rows and extra columns with any names pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import mixing, packing, secrets, simhash, toxicity
from tallyhouse.llm.queries import table, toxic_model
from tallyhouse.llm.texts import word_count
from tallyhouse.sources.scratch import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A table of source rates with more rows is joined by shuffle.
BROADCAST_SOURCES = 100_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below 0.3 stay; an empty text stays."""
    model = toxic_model(spark, docs, sf_dir)
    return docs.where(toxicity.toxicity("text", model) < 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the one with the smallest id, null ids last; equal rows count as one."""
    # Rows that differ in anything have different keys, so a repeated id loses no document.
    key = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    keyed = docs.select(F.struct("*").alias("doc"), key.alias("key"))
    classes = simhash.near_duplicates(keyed.select("key", "doc.text"), "key", "text", shingle=4, max_bits=4)
    kept = classes.where(F.col("key") == F.col("component")).select("key").distinct()
    return keyed.join(kept, "key").dropDuplicates(["key"]).select("doc.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced, and `n_chars` is that of the new text."""
    model = secrets.train(secrets.planted_findings(docs))
    path = F.coalesce(F.col("source").cast("string"), F.lit(""))
    cleaned = docs.select(F.struct("*").alias("doc"), secrets.redact(F.col("text"), path, model).alias("clean"))
    changed = ~F.col("doc.text").eqNullSafe(F.col("clean"))
    chars = F.when(changed, F.length("clean")).otherwise(F.col("doc.n_chars")).cast(docs.schema["n_chars"].dataType)
    new = {"text": F.col("clean"), "n_chars": chars}
    return cleaned.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, once or twice."""
    sizes = docs.select("source", word_count("text").alias("size"))
    rates = stored(mixing.source_rates(sizes, weights=[3, 1, 2], share_percent=150, limit=2), "rates")
    return mixing.mix(docs, rates, seed="mix", broadcast=rates.count() <= BROADCAST_SOURCES)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Learned models and tokens have no SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
