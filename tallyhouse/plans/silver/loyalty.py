"""Worker loyalty: tenure, inactivity, category, loyalty rate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import bucketize, days_between, ratio
from tallyhouse.plans.silver.common import as_date, as_long, newest

# Loyalty categories.
ACTIVE_RECENT, ACTIVE_YEAR, INACTIVE_LONG, NEVER = "actif_recent", "actif_annee", "inactif_long", "inactif"
INACTIVE_LABELS = (INACTIVE_LONG, NEVER)


def loyalty(raw_profiles: DataFrame, assignments: DataFrame, as_of: date) -> DataFrame:
    """(worker): sale dates, tenure, category and assignments of the last twelve months."""
    base = newest(
        raw_profiles,
        ["worker_id"],
        [
            as_long("PER_ID").alias("worker_id"),
            as_date("PINT_CREATDTE").alias("first_sale"),
            as_date("PINT_PREVENDTE").alias("previous_sale"),
            as_date("PINT_DERVENDTE").alias("last_sale"),
        ],
    ).drop("_batch_id")
    recent = (
        assignments.filter(F.col("start_date") >= F.add_months(F.lit(as_of), -12))
        .groupBy("worker_id")
        .agg(F.count_distinct("contract_id").alias("assignments_12m"))
    )
    idle = days_between("last_sale", F.lit(as_of))
    measured = base.join(recent, "worker_id", "left").withColumns(
        {
            "tenure_days": days_between("first_sale", "last_sale"),
            "idle_days": idle,
            "loyalty_category": bucketize(idle, ((90, ACTIVE_RECENT), (365, ACTIVE_YEAR)), INACTIVE_LONG, NEVER),
            "assignments_12m": F.coalesce("assignments_12m", F.lit(0)).cast("int"),
        }
    )
    return measured.withColumn("loyalty_rate", ratio("assignments_12m", F.col("tenure_days") / 30.0, 4))
