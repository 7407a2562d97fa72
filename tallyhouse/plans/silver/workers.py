"""Worker dimension (SCD2, pseudonymised), evaluations, contact points, portfolio."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import concat_skip_null, empty_if_null, safe_bool
from tallyhouse.operators.privacy import pseudonymize
from tallyhouse.operators.versions import scd2_first_load, scd2_merge
from tallyhouse.plans.silver.common import as_date, as_decimal, as_long, missing, newest, text

# Columns whose change opens a new worker version.
TRACKED = (
    "last_name", "first_name", "address", "city", "postcode", "is_active", "is_candidate", "is_permanent", "home_branch",
)


def worker_staging(
    raw_people: DataFrame, raw_payroll: DataFrame, raw_profiles: DataFrame, raw_branches: DataFrame, salt: str
) -> DataFrame:
    """One row per worker; the national identifier leaves only as a salted hash."""
    key = as_long("PER_ID").alias("worker_id")
    people = newest(
        raw_people,
        ["worker_id"],
        [
            key,
            text("PER_NOM").alias("last_name"),
            text("PER_PRENOM").alias("first_name"),
            as_date("PER_NAISSANCE").alias("birth_date"),
            text("PER_NIR").alias("nir"),
            empty_if_null("NAT_CODE").alias("nationality"),
            empty_if_null("PAYS_CODE").alias("country"),
            F.concat_ws(" ", "PER_BISVOIE", "PER_COMPVOIE", "PER_CP", "PER_VILLE").alias("address"),
            text("PER_VILLE").alias("city"),
            text("PER_CP").alias("postcode"),
        ],
    ).drop("_batch_id", "_loaded_at")
    payroll = newest(
        raw_payroll,
        ["worker_id"],
        [key, text("SAL_MATRICULE").alias("matricule"), as_date("SAL_DATEENTREE").alias("hired_on"),
         safe_bool("SAL_ACTIF").alias("is_active")],
    ).drop("_batch_id", "_loaded_at")
    profiles = newest(
        raw_profiles,
        ["worker_id"],
        [key, safe_bool("PINT_CANDIDAT").alias("is_candidate"), safe_bool("PINT_PERMANENT").alias("is_permanent")],
    ).drop("_batch_id", "_loaded_at")
    home = newest(
        raw_branches.filter(F.col("RGPCNT_ID").isNotNull()),
        ["worker_id"],
        [key, as_long("RGPCNT_ID").alias("home_branch")],
    ).drop("_batch_id", "_loaded_at")
    joined = (
        people.join(payroll, "worker_id", "left").join(profiles, "worker_id", "left").join(home, "worker_id", "left")
    )
    flags = ["is_active", "is_candidate", "is_permanent"]
    staged = joined.fillna(False, flags).withColumn("left_on", missing("date"))
    return pseudonymize(staged, {"nir": "nir_hash"}, salt)


def worker_versions(staging: DataFrame, existing: DataFrame | None, now: datetime | Column) -> DataFrame:
    """The type-2 worker dimension after a load; ``existing`` is None on the first one."""
    if existing is None:
        return scd2_first_load(staging, "worker_id", TRACKED, now, "worker_sk")
    return scd2_merge(staging, existing, "worker_id", TRACKED, now, "worker_sk").drop("change")


def evaluations(raw: DataFrame) -> DataFrame:
    return newest(
        raw,
        ["worker_id", "eval_id"],
        [
            F.md5(F.concat(concat_skip_null("PER_ID"), F.lit("|"), concat_skip_null("PEVAL_DU"))).alias("eval_id"),
            as_long("PER_ID").alias("worker_id"),
            as_date("PEVAL_DU").alias("evaluated_on"),
            as_decimal("PEVAL_EVALUATION", 5, 2).alias("grade"),
            missing("string").alias("comment"),
            as_long("PEVAL_UTL").alias("evaluator_id"),
        ],
    )


def contact_points(raw: DataFrame) -> DataFrame:
    """Worker phones and addresses (personal data: stays in the silver layer)."""
    return newest(
        raw,
        ["worker_id", "contact_id"],
        [
            F.md5(F.concat(concat_skip_null("PER_ID"), F.lit("|"), concat_skip_null("TYPTEL_CODE"))).alias("contact_id"),
            as_long("PER_ID").alias("worker_id"),
            text("TYPTEL_CODE").alias("contact_type"),
            text("PER_TEL_NTEL").alias("contact_value"),
            empty_if_null("PER_TEL_POSTE").alias("extension"),
            F.lit(False).alias("is_main"),
        ],
    )


def portfolio(raw: DataFrame) -> DataFrame:
    """Which branches follow a worker."""
    return newest(
        raw, ["worker_id", "branch_id"], [as_long("PER_ID").alias("worker_id"), as_long("RGPCNT_ID").alias("branch_id")]
    )
