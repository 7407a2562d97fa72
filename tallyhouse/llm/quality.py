"""Quality rules: a decision list learned by sequential covering, applied as ordered conditional expressions.

Every text gets statistics by SQL functions on its whole text.  Rules are threshold conjunctions on ratios of these.
A rule is grown on two thirds of the labelled rows that no earlier rule covers (one condition after the other, by FOIL's
gain), pruned on the other third (conditions are taken off its end while precision there doesn't fall) and accepted if it is
precise enough on all of them.  The rules stay in order; a text is rejected by the first rule that holds, else kept.

Learning sees at most `sample_rows` labelled rows (those with the smallest hash of their key), as numbers; the list is
a dozen short conditions, so applying it needs no shuffle and no Python.

Edge cases: a null or empty text has no words, fails the base rules and is not kept; a ratio with denominator zero is zero;
without labelled rows, or with one class only, the list is empty and the base rules decide; a key with several labels
is bad if one of them says so; repeated rows get equal results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.texts import let, whole, words

#: What rules may speak about, in SQL over the statistics.
RATIOS = {
    "symbols_a_word": "n_symbols / greatest(n_words, 1)",
    "marks_a_word": "n_marks / greatest(n_words, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "words": "cast(n_words as double)",
}


def repeated_words(found: Column) -> Column:
    """Words in windows of three that are found twice or more, from an array of words."""

    def window(i: Column) -> Column:
        return F.struct(F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)).alias("h"), i.alias("at"))

    def twin(windows: Column) -> Callable[[Column, Column], Column]:
        before, after = (lambda i: F.get(windows, i - 1)["h"]), (lambda i: F.get(windows, i + 1)["h"])
        no = F.lit(False)
        return lambda x, i: F.coalesce(x["h"] == before(i), no) | F.coalesce(x["h"] == after(i), no)

    def covered_by(starts: Column) -> Column:
        # Each repeated window covers three words, less what the next one covers as well.
        steps = F.transform(starts, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    # By a 64-bit hash and sorted, so that equal windows are neighbours.
    numbers = F.when(F.size(found) > 2, F.sequence(F.lit(0), F.size(found) - 3)).otherwise(F.array().cast("array<int>"))
    return let(
        F.sort_array(F.transform(numbers, window)),
        lambda windows: let(
            F.sort_array(F.transform(F.filter(windows, twin(windows)), lambda x: x["at"])),
            covered_by,
        ),
    )


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, the counts and the ratios of every whole text."""
    value = F.col("text")
    of_words = let(
        words(value),
        lambda found: F.struct(
            F.size(found).cast("long").alias("n_words"),
            F.length(F.array_join(found, "")).cast("long").alias("word_chars"),
            repeated_words(found).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        F.filter(F.split(value, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        lambda lines: F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        ),
    )
    found = docs.select(F.col(key).alias("key"), whole(text).alias("text")).select(
        "key",
        of_words.alias("of_words"),
        of_lines.alias("of_lines"),
        F.regexp_count(value, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(value, F.lit("!")).cast("long").alias("n_marks"),
        F.regexp_count(value, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count(value, F.lit("[0-9]")).cast("long").alias("n_digits"),
    )
    counts = found.select("key", "of_words.*", "of_lines.*", "n_symbols", "n_marks", "n_capitals", "n_digits")
    return counts.select("*", *[F.expr(sql).alias(name) for name, sql in RATIOS.items()])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


@dataclass(frozen=True)
class Condition:
    ratio: str
    above: bool
    bound: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        return rows[self.ratio] > self.bound if self.above else rows[self.ratio] <= self.bound

    def column(self) -> Column:
        return F.col(self.ratio) > self.bound if self.above else F.col(self.ratio) <= self.bound

    def __str__(self) -> str:
        return f"{self.ratio} {'>' if self.above else '<='} {self.bound:.6g}"


Rule = list[Condition]


def covered(rule: Rule, rows: dict[str, np.ndarray]) -> np.ndarray:
    hit = np.ones(len(next(iter(rows.values()))), bool)
    for condition in rule:
        hit &= condition.holds(rows)
    return hit


def grow(rows: dict[str, np.ndarray], bad: np.ndarray, cuts: int, most: int = 4) -> Rule:
    """Adds the condition with the largest gain until no good row is covered or nothing is gained."""
    rule: Rule = []
    inside = np.ones(len(bad), bool)
    while len(rule) < most and (~bad[inside]).any():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best, choice = 0.0, None
        for ratio, values in rows.items():
            held = values[inside]
            bounds = np.unique(np.quantile(held, np.linspace(0, 1, cuts)))[:-1]
            # Bad and good rows up to each bound.
            order = np.sort(held[bad[inside]]), np.sort(held[~bad[inside]])
            below = [np.searchsorted(x, bounds, side="right") for x in order]
            for above, (bads, goods) in ((False, below), (True, (p - below[0], n - below[1]))):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(bads > 0, bads * (np.log2(bads / (bads + goods)) - np.log2(p / (p + n))), 0)
                if len(gain) and gain.max() > best:
                    best, bound = gain.max(), bounds[gain.argmax()]
                    # Half way to the next value, so that rows just beyond those seen are not all on one side.
                    choice = Condition(ratio, above, float((bound + held[held > bound].min()) / 2))
        if choice is None:
            break
        rule.append(choice)
        inside &= choice.holds(rows)
    return rule


def prune(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule whose precision on these rows is not below that of any longer one."""

    def precision(part: Rule) -> float:
        hit = covered(part, rows)
        return (bad[hit].sum() + 1) / (hit.sum() + 2)

    return max((rule[:n] for n in range(1, len(rule) + 1)), key=lambda part: (precision(part), -len(part)))


def learn(rows: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = 0.95, min_covered: int = 3,
          most_rules: int = 12, cuts: int = 64, seed: int = 5) -> list[Rule]:
    """Rules for bad rows, in order."""
    rng = np.random.default_rng(seed)
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < most_rules and bad[left].sum() >= min_covered:
        places = rng.permutation(np.flatnonzero(left))
        third = len(places) // 3
        growing, pruning = ({k: v[part] for k, v in rows.items()} for part in (places[third:], places[:third]))
        if not bad[places[third:]].any():
            break
        rule = grow(growing, bad[places[third:]], cuts)
        if not rule:
            break
        rule = prune(rule, pruning, bad[places[:third]])
        hit = covered(rule, rows) & left
        if bad[hit].sum() < min_covered or bad[hit].mean() < min_precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        sample_rows: int = 20_000, **options) -> list[Rule]:
    """Rules from at most `sample_rows` labelled documents that pass the base rules; label 0 is bad."""
    named = labels.select(F.col(key).cast("string").alias("key"), F.col(label).cast("int").alias("label"))
    named = named.where("key is not null and label is not null").groupBy("key").agg(F.min("label").alias("label"))
    picked = named.orderBy(F.xxhash64("key"), "key").limit(sample_rows)  # bounds the broadcast and the collect
    texts = docs.select(F.col(key).cast("string").alias("key"), whole(text).alias("text"))
    sample = texts.join(F.broadcast(picked), "key").groupBy("key", "label").agg(F.min("text").alias("text"))
    sample = sample.select(F.struct("key", "label").alias("doc"), "text")
    found = statistics(sample, "doc", "text").select("key.key", "key.label", base_failed().alias("failed"), *RATIOS)
    collected = sorted(row for row in found.collect() if not row["failed"])
    if not collected:
        return []
    table = np.array([row[3:] for row in collected], float)
    return learn(dict(zip(RATIOS, table.T, strict=True)), np.array([row["label"] == 0 for row in collected]), **options)


def first_rule(rules: list[Rule]) -> Column:
    """Number (from 1) of the first rule that holds, null if none does."""
    found = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds &= condition.column()
        found = F.when(holds, F.lit(number)).otherwise(found)
    return found


def judge(docs: DataFrame, rules: list[Rule], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics, `base_failed`, `rule` (the rule that rejects) and `kept` of every document."""
    judged = statistics(docs, key, text).withColumn("base_failed", base_failed()).withColumn("rule", first_rule(rules))
    kept = ~F.col("base_failed") & F.col("rule").isNull()
    return judged.withColumn("kept", kept).withColumnRenamed("key", key)
