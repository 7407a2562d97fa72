"""Mixing sources to target weights.

One aggregate counts the words of each source.  Targets are found by filling all sources to a common level per
unit of weight, each up to its limit, in closed form over one row per source.  A source's rate is target / size; each of its
documents is taken floor(rate) times, and once more if a hash of its key, read as a uniform number, is below the rate's fraction.
That draw needs no state and no order, so reruns and repeated tasks agree.

Edge cases: a null source is a source of its own, last in order; a null text has size 0; a source of size 0 has target 0
and rate 0; repeated rows are drawn alike; an empty table gives an empty table; columns of the input keep their
values whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def source_rates(
    sizes: DataFrame, weights: list[int], share_percent: int, limit: int
) -> DataFrame:
    """`source`, `source_size`, `target` and `rate` from a table with `source` and `size` (one row per document).

    Sources by code point, null last, get the weights in turn.  Together they get `share_percent` of all sizes;
    a target above `limit` times its source's size is cut there and the excess goes to the others by weight.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    # The windows below see one row per source.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    exact = "decimal(38,0)"
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = totals.select("*", weight.cast(exact).alias("weight"), (F.col("source_size") * limit).cast(exact).alias("most"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(exact)
    # All amounts in hundredths, so that they stay whole numbers.
    amount = (F.sum("source_size").over(everything) * share_percent).cast(exact)
    spent = (F.coalesce(F.sum("most").over(earlier), zero) * 100).cast(exact)
    shared = (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), zero)).cast(exact)
    ranked = ranked.select("*", amount.alias("amount"), spent.alias("spent"), shared.alias("shared"))
    # A source is full if the level that is left for it and those after it reaches its limit.
    full = F.col("most") * 100 * F.col("shared") <= F.col("weight") * (F.col("amount") - F.col("spent"))
    ranked = ranked.withColumn("full", full)
    given = F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), zero) * 100
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    level = (F.col("weight") * (F.col("amount") - given)).cast("double") / (open_weight * 100).cast("double")
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(level)
    return ranked.select("source", "source_size", target.alias("target")).select(
        "*",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
    )


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from 52 bits of a hash of seed and key."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(rate: Column, key: Column, seed: str) -> Column:
    """How often a document is taken."""
    whole_times = F.floor(rate)
    return (whole_times + (uniform(key, seed) < rate - whole_times).cast("int")).cast("int")


def mix(
    docs: DataFrame, rates: DataFrame, key: str = "doc_id", source: str = "source", seed: str = "mix", broadcast: bool = False
) -> DataFrame:
    """Each row of `docs` as often as the mix takes it; `rates` as `source_rates` gives them.

    `broadcast` is for rates whose number is checked; else a shuffle join, whose hot source adaptive execution splits.
    """
    rates = rates.select(F.struct("source", "rate").alias("mix"))
    rows = docs.select(F.struct("*").alias("doc"))
    same = F.col(f"doc.{source}").eqNullSafe(F.col("mix.source"))
    joined = rows.join(F.broadcast(rates) if broadcast else rates, same)
    times = copies(F.col("mix.rate"), F.col(f"doc.{key}"), seed)
    return joined.select("doc", F.explode(F.array_repeat(F.lit(0), times))).select("doc.*")
