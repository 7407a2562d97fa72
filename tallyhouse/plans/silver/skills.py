"""Worker skills: trades, certifications, degrees and experience in one table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import concat_skip_null, null_if_blank
from tallyhouse.operators.dedup import latest_loaded, union_latest
from tallyhouse.plans.silver.common import as_date, as_int, as_long, as_timestamp, missing

# Skill types.
TRADE, CERTIFICATION, DEGREE, EXPERIENCE = "METIER", "HABILITATION", "DIPLOME", "EXPERIENCE"


def _reference(raw: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Newest load of a small reference table, unique on its key."""
    return latest_loaded(raw.select(key, *columns, "_loaded_at"), [key]).drop("_loaded_at")


def _skill(kind: str, code: Column, hashed_code: Column, source: str, **columns: Column) -> list[Column]:
    defaults = {
        "label": missing("string"),
        "level": missing("string"),
        "obtained_on": missing("date"),
        "expires_on": missing("date"),
        "is_active": F.lit(True),
        "pcs_code": missing("string"),
    }
    skill_id = F.md5(F.concat(concat_skip_null("PER_ID"), F.lit(f"|{kind}|"), concat_skip_null(hashed_code)))
    return [
        skill_id.alias("skill_id"),
        as_long("PER_ID").alias("worker_id"),
        F.lit(kind).alias("skill_type"),
        F.coalesce(code.cast("string"), F.lit("")).alias("code"),
        *[expr.alias(name) for name, expr in {**defaults, **columns}.items()],
        F.lit(source).alias("source_table"),
        as_timestamp("_loaded_at").alias("_loaded_at"),
    ]


def _labelled(c: str, unknown: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit(unknown))


def trades(raw: DataFrame, raw_reference: DataFrame) -> DataFrame:
    ref = _reference(raw_reference, "MET_ID", ["MET_LIBELLE", "MET_DELETE", "PCS_CODE_2003"])
    known = ref.withColumn("__ref_id", F.col("MET_ID"))
    return raw.join(known, "MET_ID", "left").select(
        *_skill(
            TRADE,
            F.col("MET_ID"),
            F.coalesce(F.col("__ref_id").cast("string"), F.col("PMET_ORDRE").cast("string")),
            "WTPMET",
            label=_labelled("MET_LIBELLE", "Métier inconnu"),
            is_active=F.coalesce(as_int("MET_DELETE"), F.lit(0)) == 0,
            pcs_code=null_if_blank("PCS_CODE_2003"),
        )
    )


def certifications(raw: DataFrame, raw_reference: DataFrame, as_of: date) -> DataFrame:
    """Expiry is the explicit date, else the issue date plus the validity in months."""
    # A few codes name all certificates: they go to the rows, not the rows of one code to one task.
    ref = F.broadcast(_reference(raw_reference, "THAB_ID", ["THAB_LIBELLE", "THAB_NBMOIS"]))
    issued = as_date("PHAB_DELIVR")
    expires = F.coalesce(as_date("PHAB_EXPIR"), F.add_months(issued, as_int("THAB_NBMOIS")))
    return raw.join(ref, "THAB_ID", "left").select(
        *_skill(
            CERTIFICATION,
            F.col("THAB_ID"),
            F.col("THAB_ID"),
            "WTPHAB",
            label=_labelled("THAB_LIBELLE", "Habilitation inconnue"),
            level=F.lit(""),
            obtained_on=issued,
            expires_on=expires,
            is_active=expires.isNull() | (expires > F.lit(as_of)),
        )
    )


def degrees(raw: DataFrame, raw_reference: DataFrame) -> DataFrame:
    ref = F.broadcast(_reference(raw_reference, "TDIP_ID", ["TDIP_LIB", "TDIP_REF"]))  # a few codes, as above
    return raw.join(ref, "TDIP_ID", "left").select(
        *_skill(
            DEGREE,
            F.col("TDIP_ID"),
            F.col("TDIP_ID"),
            "WTPDIP",
            label=_labelled("TDIP_LIB", "Diplôme inconnu"),
            level=F.nullif(F.col("TDIP_REF").cast("string"), F.lit("")),
            obtained_on=as_date("PDIP_DATE"),
        )
    )


def experiences(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_skill(
            EXPERIENCE,
            F.col("EXP_ORDRE"),
            F.col("EXP_ORDRE"),
            "WTEXP",
            label=F.trim(F.coalesce("EXP_NOM", F.lit("Expérience inconnue"))),
            obtained_on=as_date("EXP_DEBUT"),
            expires_on=as_date("EXP_FIN"),
        )
    )


def skills(*parts: DataFrame) -> DataFrame:
    """Union of the skill kinds, one row per skill id.

    The ids are MD5 in hex digits (`_skill`); they are sorted and shuffled as the 16 bytes that the digits stand for.
    """
    packed = [p.filter(F.col("worker_id").isNotNull()).withColumn("skill_id", F.unhex("skill_id")) for p in parts]
    return union_latest(packed, ["skill_id"]).withColumn("skill_id", F.lower(F.hex("skill_id")))
