"""Client dimension (SCD2), sites, contacts, credit exposure."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import change_hash, code_or_null, concat_skip_null, empty_if_null
from tallyhouse.operators.dedup import latest_by
from tallyhouse.operators.versions import scd2_first_load, scd2_merge
from tallyhouse.plans.silver.common import as_date, as_decimal, as_int, as_long, missing, newest, text

# Columns whose change opens a new client version.
TRACKED = (
    "client_name", "siren", "nic", "naf_code", "naf_label", "address", "city", "postcode",
    "client_status", "potential_revenue",
)
UNKNOWN = "INCONNU"
ADDRESS = ("TIES_ADR1", "TIES_ADR2", "TIES_CODEP", "TIES_VILLE")


def _address() -> Column:
    return F.concat_ws(" ", *[F.col(c) for c in ADDRESS])


def client_staging(raw_sites: DataFrame, raw_attributes: DataFrame, raw_crm: DataFrame | None = None) -> DataFrame:
    """One row per client: its newest site, commercial attributes and, where given, CRM status and sector."""
    sites = newest(
        raw_sites,
        ["client_id", "site_id"],
        [
            as_long("TIE_ID").alias("client_id"),
            as_long("TIES_SERV").alias("site_id"),
            text("TIES_DESIGNATION").alias("client_name"),
            empty_if_null("TIES_SIREN").alias("siren"),
            code_or_null("TIES_NIC", 5).alias("nic"),
            F.trim(F.coalesce("NAF", "NAF2008", F.lit(""))).alias("naf_code"),
            _address().alias("address"),
            text("TIES_VILLE").alias("city"),
            text("TIES_CODEP").alias("postcode"),
        ],
    )
    one_site = latest_by(sites, ["client_id"], [F.col("_loaded_at").desc_nulls_last(), F.col("site_id").asc()])
    attributes = newest(
        raw_attributes,
        ["client_id"],
        [
            as_long("TIE_ID").alias("client_id"),
            text("CLPT_PROS").alias("__status"),
            as_decimal("CLPT_CAPT", 18, 2).alias("potential_revenue"),
            as_date("CLPT_DCREA").alias("created_on"),
            text("CLPT_EFFT").alias("headcount_range"),
        ],
    ).drop("_batch_id", "_loaded_at")
    joined = one_site.join(attributes, "client_id", "left")
    if raw_crm is None:
        joined = joined.withColumns({"naf_label": F.lit(""), "__crm_status": missing("string")})
    else:
        crm = newest(
            raw_crm,
            ["client_id"],
            [
                as_long("ACCOUNT_CLIENT_ID").alias("client_id"),
                text("ACCOUNT_NAF_NAME").alias("__crm_label"),
                F.col("ACCOUNT_STATUS").alias("__crm_status"),
            ],
        ).drop("_batch_id", "_loaded_at")
        joined = joined.join(crm, "client_id", "left").withColumn("naf_label", empty_if_null("__crm_label"))
    own_status = F.nullif(F.col("__status"), F.lit(UNKNOWN))
    return joined.select(
        "client_id",
        "client_name",
        "siren",
        "nic",
        "naf_code",
        "naf_label",
        "address",
        "city",
        "postcode",
        F.trim(F.coalesce(own_status, "__crm_status", F.lit(UNKNOWN))).alias("client_status"),
        "potential_revenue",
        "created_on",
        "headcount_range",
    )


def client_versions(staging: DataFrame, existing: DataFrame | None, now: datetime | Column) -> DataFrame:
    """The type-2 client dimension after a load; ``existing`` is None on the first one."""
    if existing is None:
        return scd2_first_load(staging, "client_id", TRACKED, now, "client_sk")
    return scd2_merge(staging, existing, "client_id", TRACKED, now, "client_sk").drop("change")


def sites(raw: DataFrame) -> DataFrame:
    """Client sites with a fingerprint of their identity columns."""
    nic = code_or_null("TIES_NIC", 5)
    fingerprint = change_hash(
        [
            empty_if_null("TIES_SIREN"),
            F.coalesce(nic, F.lit("")),
            empty_if_null("TIES_ADR1"),
            empty_if_null("TIES_CODEP"),
            empty_if_null("TIES_VILLE"),
            F.lower(empty_if_null("TIES_EMAIL")),
        ]
    )
    return newest(
        raw,
        ["client_id", "site_id"],
        [
            as_long("TIES_SERV").alias("site_id"),
            as_long("TIE_ID").alias("client_id"),
            text("TIES_DESIGNATION").alias("site_name"),
            empty_if_null("TIES_SIREN").alias("siren"),
            nic.alias("nic"),
            _address().alias("address"),
            text("TIES_VILLE").alias("city"),
            text("TIES_CODEP").alias("postcode"),
            F.upper(F.trim(F.coalesce("PAYS_CODE", F.lit("FR")))).alias("country"),
            F.lower(text("TIES_EMAIL")).alias("email"),
            as_long("RGPCNT_ID").alias("branch_id"),
            F.col("CLOT_DAT").isNull().alias("is_active"),
            as_date("CLOT_DAT").alias("closed_on"),
            fingerprint.alias("row_hash"),
        ],
    )


def contacts(raw: DataFrame) -> DataFrame:
    """Client contacts (personal data: stays in the silver layer)."""
    return newest(
        raw,
        ["client_id", "contact_no"],
        [
            F.md5(F.concat(concat_skip_null("TIE_ID"), F.lit("|"), concat_skip_null("TIEI_ORDRE"))).alias("contact_id"),
            as_long("TIE_ID").alias("client_id"),
            as_int("TIEI_ORDRE").alias("contact_no"),
            text("TIEI_NOM").alias("last_name"),
            text("TIEI_PRENOM").alias("first_name"),
            text("TIEI_EMAIL").alias("email"),
            text("TIEI_BUREAU").alias("phone"),
            text("FCTI_CODE").alias("function_code"),
        ],
    )


def credit_exposures(raw: DataFrame) -> DataFrame:
    """Credit decisions per group; amounts are not delivered."""
    return newest(
        raw,
        ["exposure_id"],
        [
            as_long("ENCGRP_ID").alias("exposure_id"),
            text("ENC_SIREN").alias("siren"),
            missing("decimal(18,2)").alias("credit_used"),
            missing("decimal(18,2)").alias("credit_limit"),
            missing("date").alias("decided_on"),
            empty_if_null("ENCG_DECISIONLIB").alias("decision"),
        ],
    )


__all__ = [
    "TRACKED", "client_staging", "client_versions", "contacts", "credit_exposures", "sites",
]
