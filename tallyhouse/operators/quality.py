"""Expectations, reconciliation, schema drift and table probes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyhouse.functions import round_to


@dataclass(frozen=True)
class Rule:
    """One expectation.

    kinds: exists, not_null, unique, length, between, in_set, row_count.
    ``mostly`` is the share of non-NULL values (of rows for not_null) that must comply.
    """

    kind: str
    column: str | None = None
    mostly: float = 1.0
    args: dict[str, Any] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return self.kind if self.column is None else f"{self.kind}:{self.column}"


def _within(value: Column, args: Mapping[str, Any]) -> Column:
    checks = []
    if args.get("min") is not None:
        checks.append(value >= F.lit(args["min"]))
    if args.get("max") is not None:
        checks.append(value <= F.lit(args["max"]))
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def _compliant(rule: Rule) -> Column:
    value = F.col(rule.column)
    if rule.kind == "not_null":
        return value.isNotNull()
    if rule.kind == "length":
        return F.length(value.cast("string")) == rule.args["value"]
    if rule.kind == "between":
        return _within(value, rule.args)
    if rule.kind == "in_set":
        return value.isin(list(rule.args["values"]))
    raise ValueError(f"unknown rule kind {rule.kind}")


def run_expectations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: observed, threshold, passed.

    Row rules share one aggregate over the table; uniqueness groups by the column first, so each
    checked column is counted from partial groups.
    """
    rows = F.count(F.lit(1)).cast("double")
    row_exprs, parts = [], []
    for i, rule in enumerate(rules):
        missing = rule.column is not None and rule.column not in df.columns
        if rule.kind == "exists" or missing:
            observed, threshold = F.lit(0.0 if missing else 1.0), 1.0
            row_exprs.append((i, rule, F.min(observed), F.lit(threshold)))
        elif rule.kind == "row_count":
            ok = _within(F.count(F.lit(1)), rule.args)
            row_exprs.append((i, rule, rows, F.lit(float(rule.args.get("min") or 0)), ok))
        elif rule.kind == "unique":
            counts = df.filter(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(F.count(F.lit(1)).alias("n"))
            total = F.coalesce(F.sum("n"), F.lit(0))
            single = F.coalesce(F.sum(F.when(F.col("n") == 1, 1)), F.lit(0))
            share = F.coalesce(F.try_divide(single.cast("double"), total.cast("double")), F.lit(1.0))
            parts.append(
                counts.agg(share.alias("observed")).select(
                    F.lit(rule.name).alias("rule"),
                    round_to("observed", 6).alias("observed"),
                    F.lit(rule.mostly).alias("threshold"),
                    (F.col("observed") >= rule.mostly).alias("passed"),
                )
            )
        else:
            base = rows if rule.kind == "not_null" else F.count(F.col(rule.column)).cast("double")
            share = F.coalesce(F.try_divide(F.count_if(_compliant(rule)).cast("double"), base), F.lit(1.0))
            row_exprs.append((i, rule, share, F.lit(rule.mostly)))
    if row_exprs:
        structs = []
        for entry in row_exprs:
            _, rule, observed, threshold = entry[:4]
            passed = entry[4] if len(entry) == 5 else observed >= threshold
            structs.append(
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    round_to(observed, 6).alias("observed"),
                    threshold.cast("double").alias("threshold"),
                    passed.alias("passed"),
                )
            )
        parts.insert(0, df.agg(F.array(*structs).alias("r")).select(F.inline("r")))
    return reduce(DataFrame.unionByName, parts)


def expectation_states(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, good, base): additive counts of one batch for every rule but uniqueness, from one aggregate."""
    rows, cells = F.count(F.lit(1)), []
    for rule in rules:
        missing = rule.column is not None and rule.column not in df.columns
        if rule.kind == "unique" and not missing:
            continue
        if rule.kind == "exists" or missing:
            good, base = F.lit(0 if missing else 1), F.lit(1)
        elif rule.kind == "row_count":
            good = base = rows
        else:
            good = F.count_if(_compliant(rule))
            base = rows if rule.kind == "not_null" else F.count(F.col(rule.column))
        counts = [F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in (("good", good), ("base", base))]
        cells.append(F.struct(F.lit(rule.name).alias("rule"), *counts))
    return df.agg(F.array(*cells).alias("r")).select(F.inline("r"))


def value_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, value, n): additive counted values of one batch for its uniqueness rules."""
    parts = [
        df.filter(F.col(rule.column).isNotNull())
        .groupBy(F.lit(rule.name).alias("rule"), F.col(rule.column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        for rule in rules
        if rule.kind == "unique" and rule.column in df.columns
    ]
    empty = df.limit(0).select(F.lit("").alias("rule"), F.lit("").alias("value"), F.lit(0).cast("long").alias("n"))
    return reduce(DataFrame.unionByName, parts, empty)


def report_from_states(states: DataFrame, values: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The report of `run_expectations` on all batches whose states and counted values are given."""
    spark = states.sparkSession
    limits = [(r.args.get("min"), r.args.get("max")) if r.kind == "row_count" else (None, None) for r in rules]
    asked = [
        (r.name, r.kind, float(r.mostly), *(None if x is None else float(x) for x in limit))
        for r, limit in zip(rules, limits, strict=True)
    ]
    declared = spark.createDataFrame(asked, "rule string, kind string, mostly double, low double, high double")
    summed = states.groupBy("rule").agg(F.sum("good").alias("good"), F.sum("base").alias("base"))
    merged = values.groupBy("rule", "value").agg(F.sum("n").alias("n"))
    counted = merged.groupBy("rule").agg(F.coalesce(F.sum(F.when(F.col("n") == 1, 1)), F.lit(0)).alias("good"), F.sum("n").alias("base"))
    known = declared.join(summed.unionByName(counted), "rule", "left").fillna(0, ["good", "base"])
    share = F.coalesce(F.try_divide(F.col("good").cast("double"), F.col("base").cast("double")), F.lit(1.0))
    rows, whole = F.col("base").cast("double"), F.col("kind") == "exists"
    observed = F.when(F.col("kind") == "row_count", rows).when(whole, F.floor(share).cast("double")).otherwise(share)
    low = F.coalesce("low", F.lit(0.0))
    threshold = F.when(F.col("kind") == "row_count", low).when(whole, 1.0).otherwise(F.col("mostly"))
    enough = (rows >= low) & (rows <= F.coalesce("high", rows))
    return known.withColumns({"exact": observed, "threshold": threshold}).select(
        "rule",
        round_to("exact", 6).alias("observed"),
        "threshold",
        F.when(F.col("kind") == "row_count", enough).otherwise(F.col("exact") >= F.col("threshold")).alias("passed"),
    )


def reconcile(
    actual: DataFrame, expected: DataFrame, key: str, measure: str, tolerance_pct: float = 0.5
) -> DataFrame:
    """Per key of either side: |Δ| / |expected| in percent, PASS / FAIL / UNCALIBRATED (no reference)."""
    left = actual.select(key, F.col(measure).cast("double").alias("actual"))
    right = expected.select(key, F.col(measure).cast("double").alias("expected"))
    both = left.join(right, key, "full_outer").fillna(0.0, ["actual", "expected"])
    delta = F.abs(F.col("actual") - F.col("expected")) / F.abs(F.nullif(F.col("expected"), F.lit(0.0))) * 100
    return both.withColumn("__delta", delta).select(
        key,
        "actual",
        "expected",
        round_to("__delta", 3).alias("delta_pct"),
        F.when(F.col("expected") == 0, "UNCALIBRATED")
        .when(F.col("__delta") < tolerance_pct, "PASS")
        .otherwise("FAIL")
        .alias("status"),
    )


def schema_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare declared and actual columns per table.

    expected: domain, table_name, column_name, uncertain; actual: table_name, column_name.
    PASS nothing missing, WARN only uncertain columns missing, FAIL otherwise, NOT_FOUND without any column.
    """
    on = ["table_name", "column_name"]
    both = (
        expected.withColumn("declared", F.lit(True))
        .join(actual.select(*on).distinct().withColumn("present", F.lit(True)), on, "full_outer")
        .withColumns({"declared": F.coalesce("declared", F.lit(False)), "present": F.coalesce("present", F.lit(False))})
    )
    missing = F.col("declared") & ~F.col("present")
    names = F.col("column_name")
    tables = both.groupBy("table_name").agg(
        F.max("domain").alias("domain"),
        F.count_if("declared").alias("expected_columns"),
        F.count_if("present").alias("actual_columns"),
        F.array_join(F.array_sort(F.collect_list(F.when(missing & ~F.col("uncertain"), names))), ",").alias("missing"),
        F.array_join(F.array_sort(F.collect_list(F.when(missing & F.col("uncertain"), names))), ",").alias(
            "missing_uncertain"
        ),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("declared"), names))), ",").alias("extra"),
        F.count_if(missing & ~F.col("uncertain")).alias("__confirmed"),
        F.count_if(missing).alias("__missing"),
    )
    status = (
        F.when(F.col("actual_columns") == 0, "NOT_FOUND")
        .when(F.col("__missing") == 0, "PASS")
        .when(F.col("__confirmed") == 0, "WARN")
        .otherwise("FAIL")
    )
    return (
        tables.filter(F.col("expected_columns") > 0).withColumn("status", status).drop("__confirmed", "__missing")
    )


def drift_by_domain(drift: DataFrame) -> DataFrame:
    """Tables per domain and status."""
    return drift.groupBy("domain", "status").agg(F.count(F.lit(1)).alias("tables"))


def table_probe(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count per table, without reading the data columns."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def copy_integrity(sources: Mapping[str, DataFrame], targets: Mapping[str, DataFrame], threshold: float = 0.99):
    """Target rows against source rows per table; a copy passes from ``threshold`` on."""
    before = table_probe(sources).select("table_name", F.col("row_count").alias("source_rows"))
    after = table_probe(targets).select("table_name", F.col("row_count").alias("target_rows"))
    joined = before.join(after, "table_name", "left").fillna(0, ["target_rows"])
    share = F.coalesce(F.try_divide(F.col("target_rows").cast("double"), F.col("source_rows").cast("double")), F.lit(1.0))
    return joined.withColumn("integrity", round_to(share, 6)).withColumn("passed", share >= threshold)


def observe_rows(df: DataFrame, valid: Column, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count processed and rejected rows in the pass that writes them."""
    seen = Observation(name)
    return df.observe(
        seen, F.count(F.lit(1)).alias("processed"), F.count_if(~F.coalesce(valid, F.lit(False))).alias("rejected")
    ), seen
