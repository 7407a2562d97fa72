"""Dimensions published to the gold layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import composite_id, empty_if_null, key_hash, null_if_blank
from tallyhouse.operators.dedup import current_versions, latest_loaded

# Columns of the worker dimension that may leave the silver layer.
PUBLIC_WORKER_COLUMNS = (
    "worker_sk", "worker_id", "matricule", "last_name", "first_name", "city", "postcode",
    "hired_on", "is_active", "is_candidate", "is_permanent", "home_branch",
)


def branch_dim(branches: DataFrame, territory: DataFrame) -> DataFrame:
    """Branches with their territory ('' where unknown)."""
    joined = branches.join(territory.select("branch_id", "sector", "perimeter", "zone"), "branch_id", "left")
    return joined.fillna("", ["sector", "perimeter", "zone", "city"])


def client_dim(clients: DataFrame) -> DataFrame:
    """Current clients; the establishment number exists only when both of its parts are valid."""
    return current_versions(clients, "client_id").select(
        "client_sk",
        "client_id",
        "client_name",
        null_if_blank("siren").alias("siren"),
        "nic",
        composite_id("siren", 9, "nic", 5).alias("siret"),
        "naf_code",
        null_if_blank("naf_label").alias("naf_label"),
        "city",
        "postcode",
        "client_status",
        "headcount_range",
    )


def worker_dim(workers: DataFrame) -> DataFrame:
    """Current workers, public columns only."""
    return current_versions(workers, "worker_id").select(*PUBLIC_WORKER_COLUMNS)


def trade_dim(raw_trades: DataFrame, raw_qualifications: DataFrame) -> DataFrame:
    """Trades from the raw references: newest load per id, soft-deleted rows dropped."""
    trades = latest_loaded(
        raw_trades.select(
            "MET_ID", "MET_CODE", "MET_LIBELLE", "TQUA_ID", "SPE_ID", "NIVQ_ID", "PCS_CODE_2003", "MET_DELETE", "_loaded_at"
        ),
        ["MET_ID"],
    )
    labels = latest_loaded(raw_qualifications.select("TQUA_ID", "TQUA_LIBELLE", "_loaded_at"), ["TQUA_ID"])
    live = trades.filter(F.coalesce(F.col("MET_DELETE").try_cast("int"), F.lit(0)) == 0)
    return live.join(labels.select("TQUA_ID", "TQUA_LIBELLE"), "TQUA_ID", "left").select(
        key_hash("MET_ID").alias("trade_sk"),
        F.col("MET_ID").cast("long").alias("trade_id"),
        empty_if_null("MET_CODE").alias("trade_code"),
        empty_if_null("MET_LIBELLE").alias("trade_name"),
        empty_if_null("TQUA_LIBELLE").alias("qualification"),
        empty_if_null("SPE_ID").alias("speciality"),
        empty_if_null("NIVQ_ID").alias("level"),
        null_if_blank("PCS_CODE_2003").alias("pcs_code"),
    )


def _coded_skills(skills: DataFrame, kind: str) -> DataFrame:
    return skills.filter((F.col("skill_type") == kind) & (F.col("code") != "")).groupBy("code")


def certification_dim(skills: DataFrame) -> DataFrame:
    """One row per certification code."""
    return _coded_skills(skills, "HABILITATION").agg(
        F.md5(F.first("code")).alias("certification_sk"),
        F.max("label").alias("label"),
        F.bool_or("is_active").alias("is_active"),
    )


def degree_dim(skills: DataFrame) -> DataFrame:
    """One row per degree code."""
    return _coded_skills(skills, "DIPLOME").agg(
        F.md5(F.first("code")).alias("degree_sk"),
        F.max("label").alias("label"),
        F.max("level").alias("level"),
        F.bool_or("is_active").alias("is_active"),
    )
