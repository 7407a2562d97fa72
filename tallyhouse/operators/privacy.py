"""Pseudonymisation, PII profiling, erasure and secure views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import round_to, salted_hash
from tallyhouse.operators.joins import without

ColumnName = str | Column

# Column-name patterns of the privacy classes, first match wins.
NAME_CLASSES = {
    "SENSITIVE": r"(?i)(^|_)(nir|iban|rib|secu|num_secu|per_nir|per_iban)($|_)",
    "PERSONAL": r"(?i)(^|_)(nom|prenom|adresse|email|telephone|tel|date_naissance|datenais|coord_valeur|commentaire"
    r"|name|first_name|last_name|address|phone|birth_date|comment)($|_)",
    "INTERNAL": r"(?i)(^|_)(ca_|marge_|montant_|coef_|taux_|revenue_|margin_|amount_|rate_)",
}
# Column names that must not occur in gold.
FORBIDDEN_IN_GOLD = {
    "per_nir", "nir", "iban", "per_iban", "rib", "email", "telephone", "tel", "coord_valeur", "valeur",
    "commentaire", "peval_commentaire", "phone", "contact_value", "comment",
}
# What a PII value looks like.
VALUE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?\d[\d .()-]{7,}\d",
    "iban": r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b",
    "ip_address": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
}
# Salts that show the setting was forgotten.
DEFAULT_SALTS = {"", "changeme", "change_me", "default", "salt", "secret"}
MIN_SALT_LENGTH = 16


def check_salt(salt: str | None) -> str:
    """Refuse missing, default or short salts."""
    if salt is None or salt.strip().lower() in DEFAULT_SALTS or len(salt) < MIN_SALT_LENGTH:
        raise ValueError("a privacy salt of at least 16 characters must be configured")
    return salt


def pseudonymize(df: DataFrame, columns: Mapping[str, str], salt: str) -> DataFrame:
    """Replace raw identifier columns by salted SHA-256 columns (raw name → new name)."""
    check_salt(salt)
    hashed = {new: salted_hash(raw, salt) for raw, new in columns.items()}
    return df.withColumns(hashed).drop(*[raw for raw, new in columns.items() if raw != new])


def classify_column(name: ColumnName) -> Column:
    """Privacy class of a column name."""
    value = F.col(name) if isinstance(name, str) else name
    first, *rest = NAME_CLASSES.items()
    expr = F.when(value.rlike(first[1]), first[0])
    for label, pattern in rest:
        expr = expr.when(value.rlike(pattern), label)
    return expr.otherwise("PUBLIC")




def privacy_audit(columns: DataFrame) -> DataFrame:
    """Classify (layer, table_name, column_name) rows and flag what must not be in its layer."""
    lower = F.lower("column_name")
    classified = columns.withColumn("privacy_class", classify_column(lower))
    gold, silver = F.col("layer") == "gold", F.col("layer") == "silver"
    violation = (
        F.when(gold & ((F.col("privacy_class") == "SENSITIVE") | lower.isin(*FORBIDDEN_IN_GOLD)), "forbidden in gold")
        .when(silver & lower.isin("per_nir", "nir"), "raw identifier in silver")
    )
    return classified.withColumn("violation", violation)


def audit_status(audit: DataFrame) -> DataFrame:
    """Columns per layer and class, and the overall verdict of each layer."""
    return audit.groupBy("layer").agg(
        F.count(F.lit(1)).alias("columns"),
        *[F.count_if(F.col("privacy_class") == c).alias(c.lower()) for c in (*NAME_CLASSES, "PUBLIC")],
        F.count("violation").alias("violations"),
        F.when(F.count("violation") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def pii_profile(df: DataFrame, columns: Sequence[str], patterns: Mapping[str, str] = VALUE_PATTERNS) -> DataFrame:
    """Per text column: how many values contain each kind of PII, in one pass over whole values."""
    cells = []
    for c in columns:
        value = F.col(c)
        hits = [F.count_if(value.rlike(p)).alias(f"{kind}_hits") for kind, p in patterns.items()]
        any_hit = reduce(lambda a, b: a | b, [value.rlike(p) for p in patterns.values()])
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(value).alias("filled"),
                *hits,
                round_to(
                    F.coalesce(F.try_divide(F.count_if(any_hit).cast("double"), F.count(value).cast("double")), F.lit(0.0)),
                    4,
                ).alias("pii_share"),
            )
        )
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c"))


def forget_subjects(tables: Mapping[str, DataFrame], subjects: DataFrame, key: str) -> dict[str, DataFrame]:
    """Every table that holds the key, without the subjects' rows; other tables unchanged."""
    return {name: without(df, subjects, key) if key in df.columns else df for name, df in tables.items()}


def secure_view(
    df: DataFrame,
    grants: DataFrame,
    user: str,
    on: str,
    masked: Mapping[str, Sequence[str]],
    role: str,
) -> DataFrame:
    """Rows of the user's branches, without the columns hidden from the role.

    ``grants``: username and the ``on`` key.  ``masked``: hidden columns of each known role; a role that is not in
    it sees only the ``on`` key.
    """
    allowed = grants.filter(F.col("username") == user).select(on)
    visible = [c for c in df.columns if c not in masked[role]] if role in masked else [on]
    return df.join(allowed, on, "left_semi").select(*visible)
