"""Branches and their territory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import key_hash, null_if_blank
from tallyhouse.operators.dedup import latest_by
from tallyhouse.operators.joins import text_bridge
from tallyhouse.plans.silver.common import as_date, as_long, missing, newest, text

MANAGEMENT_COLUMNS = ("ID_UG", "NOM_UG", "MARQUE", "BRANCHE", "NOM_COMMERCIAL", "CODE_COMM", "DATE_UG_GEST")


def newest_management(raw: DataFrame) -> DataFrame:
    """One management row per branch: the newest management date."""
    kept = raw.select(*MANAGEMENT_COLUMNS).filter(F.col("ID_UG").isNotNull())
    ties = [F.col(c).asc_nulls_last() for c in MANAGEMENT_COLUMNS if c not in ("ID_UG", "DATE_UG_GEST")]
    return latest_by(kept, ["ID_UG"], [F.col("DATE_UG_GEST").desc_nulls_last(), *ties])


def branches(raw: DataFrame, raw_management: DataFrame | None = None) -> DataFrame:
    """Branch dimension; brand columns stay NULL when the management source is absent."""
    heads = newest(
        raw,
        ["branch_id"],
        [
            key_hash("RGPCNT_ID").alias("branch_sk"),
            as_long("RGPCNT_ID").alias("branch_id"),
            text("RGPCNT_LIBELLE").alias("branch_name"),
            text("RGPCNT_CODE").alias("branch_code"),
            F.col("DATE_CLOTURE").isNotNull().alias("is_closed"),
            F.col("DATE_CLOTURE").isNull().alias("is_active"),
            as_date("DATE_CLOTURE").alias("closed_on"),
        ],
    )
    absent = {c: missing("string") for c in ("brand", "line", "commercial_name", "commercial_code")}
    if raw_management is None:
        joined = heads.withColumns(absent)
    else:
        management = newest_management(raw_management).select(
            as_long("ID_UG").alias("branch_id"),
            null_if_blank("MARQUE").alias("brand"),
            null_if_blank("BRANCHE").alias("line"),
            text("NOM_COMMERCIAL").alias("commercial_name"),
            text("CODE_COMM").alias("commercial_code"),
        )
        joined = heads.join(management, "branch_id", "left")
    return joined.withColumns({"city": missing("string"), "email": missing("string")})


def territory(raw_management: DataFrame, raw_sectors: DataFrame) -> DataFrame:
    """Sector, perimeter and zone per branch, bridged on the branch name."""
    names = newest_management(raw_management).select(as_long("ID_UG").alias("branch_id"), "NOM_UG")
    sectors = raw_sectors.select(
        F.col("`Agence de gestion`").alias("agency"),
        F.trim("Secteur").alias("sector"),
        F.trim("`Périmètre`").alias("perimeter"),
        F.trim("`Zone Géographique`").alias("zone"),
    )
    return text_bridge(names, "NOM_UG", sectors, "agency").select("branch_id", "sector", "perimeter", "zone")
