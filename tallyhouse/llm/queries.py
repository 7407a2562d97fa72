"""The registered queries of this package: name → (session, data folder) → DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    conversation_repair,
    embedding_dups,
    hard_negatives,
    html_text,
    id_files,
    licenses,
    mixing,
    packing,
    quality,
    secrets,
    simhash,
    toxicity,
)
from tallyhouse.llm.texts import word_count
from tallyhouse.llm.token_counts import count_tokens
from tallyhouse.sources.scratch import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op2_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = embedding_dups.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)
    kept = F.col("vec_id").eqNullSafe(F.col("component"))
    return classes.select("vec_id", "n_links", F.col("component").alias("component_id"), kept.alias("kept"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    judged = quality.judge(docs, rules)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "rule", "kept")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stored(docs.select("doc_id", "source", word_count("text").alias("size")), "sizes")
    rates = mixing.source_rates(sized, weights=[3, 1, 2], share_percent=150, limit=2)
    rates = rates.withColumnRenamed("source", "rate_source")
    joined = sized.join(rates, F.col("source").eqNullSafe(F.col("rate_source")))
    times = mixing.copies(F.col("rate"), F.col("doc_id"), seed="mix")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken")
    )


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.main_text(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = secrets.train(secrets.planted_findings(docs))
    found = secrets.scan(docs, model, path="source")
    return found.select("doc_id", F.col("place").alias("word_at"), F.col("value").alias("secret"), "score")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), capacity=2048)


def op8_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4, seed=42)
    return classes.select("doc_id", "fingerprint", F.col("component").alias("component_id"))


def toxic_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Fitted on labelled rows outside the held-out quarter."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.fit(docs, labels.where(~held_out("doc_id")))


def held_out(key: str):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxic_model(spark, docs, sf_dir)
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), toxicity.toxicity("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults; `times` is how often a row stands there, 0 where it was dropped."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(damaged(table(spark, sf_dir, "conversations")), times=F.col("times"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (own + 1) % 10).otherwise(own)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), is_anchor=F.col("id") % 50 == 0, label=label)


def op13_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.round_trip(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_embedding_near_duplicates": op2_embedding_near_duplicates,
    "op3_quality_rules": op3_quality_rules,
    "op4_mix_sources": op4_mix_sources,
    "op5_html_main_text": op5_html_main_text,
    "op6_secret_scan": op6_secret_scan,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_simhash_near_duplicates": op8_simhash_near_duplicates,
    "op9_toxicity": op9_toxicity,
    "op10_license_scan": op10_license_scan,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_id_files": op13_token_id_files,
}

ORACLE_SQL: dict[str, str] = {
    "op2_embedding_near_duplicates": """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.v, b.v) AS c
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95 AND isfinite(list_cosine_similarity(a.v, b.v))),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM vectors v JOIN least l ON l.a = v.vec_id LEFT JOIN counted c ON c.a = v.vec_id
""",
    "op4_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::HUGEINT AS weight,
         (2 * source_size)::HUGEINT AS most FROM totals),
levels AS (
  SELECT *, (3 * sum(source_size) OVER ())::HUGEINT AS amount2,
         coalesce(sum(most) OVER earlier, 0)::HUGEINT AS spent,
         (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))::HUGEINT AS shared
  FROM ranked
  WINDOW earlier AS (ORDER BY most::DOUBLE / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, 2 * most * shared <= weight * (amount2 - 2 * spent) AS is_full FROM levels),
targets AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN most::DOUBLE
         ELSE (50 * weight * (amount2 - 2 * coalesce(sum(CASE WHEN is_full THEN most END) OVER (), 0)))::DOUBLE
              / (100 * sum(CASE WHEN NOT is_full THEN weight END) OVER ())::DOUBLE END AS target
  FROM filled),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
drawn AS (
  SELECT s.doc_id, s.source, s.size, r.source_size, r.target, r.rate,
         ('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, source, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
""",
    "op11_conversation_repair": r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
checked AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(range(1, len(name) + 1), lambda i: ascii(name[i])::UBIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], list_transform(range(8), lambda i: 0::UBIGINT)),
      lambda bits, i: CASE WHEN bits % 2 = 1 THEN xor(bits // 2, 3988292384::UBIGINT) ELSE bits // 2 END))) % 20 AS fault
  FROM given),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM checked),
named AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (
  SELECT conv, turn, role, text, substr(role, 1, 1) AS initial, rtrim(text, E' 	
') AS bare,
         row_number() OVER in_order AS place, lag(substr(role, 1, 1)) OVER in_order || substr(role, 1, 1) AS pair,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS said
  FROM damaged JOIN named ON damaged.conv_id IS NOT DISTINCT FROM named.conv_id
  WINDOW in_order AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy)),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN said > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
counted AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv),
cheapest AS (  -- cost, edits and repaired rows of all from `place` on, by state: nothing, after s, after u, after a
  SELECT conv, n + 1 AS place,
         {'c': 0::BIGINT, 's': '', 'r': []::VARCHAR[]} AS f0, {'c': 6::BIGINT, 's': 'II', 'r': ['user:', 'assistant:']} AS f1,
         {'c': 3::BIGINT, 's': 'I', 'r': ['assistant:']} AS f2, {'c': 0::BIGINT, 's': '', 'r': []::VARCHAR[]} AS f3
  FROM counted
  UNION ALL
  SELECT conv, place,
         least(p0, {'c': 3 + g2.c, 's': 'I' || g2.s, 'r': list_concat(['user:'], g2.r)}),
         least(p1, {'c': 3 + g2.c, 's': 'I' || g2.s, 'r': list_concat(['user:'], g2.r)}), g2,
         least(p3, {'c': 3 + p2.c, 's': 'I' || p2.s, 'r': list_concat(['user:'], p2.r)})
  FROM (
    SELECT *, least(p2, {'c': 3 + p3.c, 's': 'I' || p3.s, 'r': list_concat(['assistant:'], p3.r)}) AS g2
    FROM (
      SELECT j.conv, j.place,
        CASE WHEN j.fault IN ('blank', 'duplicate') THEN d0
             ELSE least(d0, to_user, CASE initial WHEN 'u' THEN keep_u WHEN 's' THEN keep_s ELSE d0 END) END AS p0,
        CASE WHEN j.fault IN ('blank', 'duplicate') THEN d1
             ELSE least(d1, to_user, CASE initial WHEN 'u' THEN keep_u ELSE d1 END) END AS p1,
        CASE WHEN j.fault IN ('blank', 'duplicate') THEN d2
             ELSE least(d2, to_assistant, CASE initial WHEN 'a' THEN keep_a ELSE d2 END) END AS p2,
        CASE WHEN j.fault IN ('blank', 'duplicate') THEN d3
             ELSE least(d3, to_user, CASE initial WHEN 'u' THEN keep_u ELSE d3 END) END AS p3
      FROM (
        SELECT c.f0, j.*,
          {'c': 4 + f0.c, 's': 'D' || f0.s, 'r': f0.r} AS d0, {'c': 4 + f1.c, 's': 'D' || f1.s, 'r': f1.r} AS d1,
          {'c': 4 + f2.c, 's': 'D' || f2.s, 'r': f2.r} AS d2, {'c': 4 + f3.c, 's': 'D' || f3.s, 'r': f3.r} AS d3,
          {'c': more + 3 + f2.c, 's': 'R' || f2.s, 'r': list_concat(['user:' || text], f2.r)} AS to_user,
          {'c': more + 3 + f3.c, 's': 'R' || f3.s, 'r': list_concat(['assistant:' || text], f3.r)} AS to_assistant,
          {'c': more + f1.c, 's': 'K' || f1.s, 'r': list_concat([role || ':' || text], f1.r)} AS keep_s,
          {'c': more + f2.c, 's': 'K' || f2.s, 'r': list_concat([role || ':' || text], f2.r)} AS keep_u,
          {'c': more + f3.c, 's': 'K' || f3.s, 'r': list_concat([role || ':' || text], f3.r)} AS keep_a
        FROM cheapest c
        JOIN (SELECT *, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM judged) j
          ON j.conv = c.conv AND j.place = c.place - 1) j)))
SELECT n.conv_id, coalesce(k.gaps, 0)::BIGINT AS gaps, coalesce(k.blank, 0)::BIGINT AS blank,
       coalesce(k.duplicate, 0)::BIGINT AS duplicate, coalesce(k.truncated, 0)::BIGINT AS truncated,
       coalesce(k.illegal, 0)::BIGINT AS illegal, coalesce(c.f0.c, 0)::BIGINT AS cost, coalesce(c.f0.s, '') AS audit,
       sha256(coalesce(array_to_string(c.f0.r, chr(10)), '')) AS repaired_sha256
FROM named n LEFT JOIN counted k ON k.conv = n.conv LEFT JOIN cheapest c ON c.conv = n.conv AND c.place = 1
""",
    "op12_hard_negatives": """
WITH taken AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         coalesce(list_inner_product(a.v, b.v), 0)::BIGINT AS score
  FROM taken a JOIN taken b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
""",
}
