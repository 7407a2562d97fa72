"""Reference data: calendar, activity sectors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# French public holidays on a fixed day, as (month, day).
FIXED_HOLIDAYS = ((1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25))
# French day names (Monday first) and month names.
DAY_NAMES = ("lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche")
MONTH_NAMES = (
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
)
# NAF sections (INSEE) with their range of two-digit divisions.
NAF_SECTIONS = (
    ("A", "Agriculture, sylviculture et pêche", "01", "03"),
    ("B", "Industries extractives", "05", "09"),
    ("C", "Industrie manufacturière", "10", "33"),
    ("D", "Production et distribution énergie", "35", "35"),
    ("E", "Eau, assainissement, déchets", "36", "39"),
    ("F", "Construction", "41", "43"),
    ("G", "Commerce, réparation automobiles", "45", "47"),
    ("H", "Transports et entreposage", "49", "53"),
    ("I", "Hébergement et restauration", "55", "56"),
    ("J", "Information et communication", "58", "63"),
    ("K", "Activités financières et assurance", "64", "66"),
    ("L", "Activités immobilières", "68", "68"),
    ("M", "Activités spécialisées et techniques", "69", "75"),
    ("N", "Services administratifs et de soutien", "77", "82"),
    ("O", "Administration publique", "84", "84"),
    ("P", "Enseignement", "85", "85"),
    ("Q", "Santé humaine et action sociale", "86", "88"),
    ("R", "Arts, spectacles et loisirs", "90", "93"),
    ("S", "Autres activités de services", "94", "96"),
    ("T", "Ménages employeurs", "97", "98"),
    ("U", "Activités extra-territoriales", "99", "99"),
)
UNKNOWN_SECTION, UNKNOWN_SECTOR = "XX", "Non classifié"


def sector_ref(spark: SparkSession) -> DataFrame:
    """The 21 activity sections."""
    return spark.createDataFrame(
        list(NAF_SECTIONS), "section_code string, sector_label string, division_min string, division_max string"
    )


def sector_lookup(df: DataFrame, division: str) -> DataFrame:
    """Add section and label of a two-digit division.

    The ranges of the fixed 21-row seed are unrolled to at most 99 division codes, so the range
    classification is an equi join against a broadcast of known size.
    """
    seed = sector_ref(df.sparkSession)
    codes = seed.select(
        F.col("section_code").alias("naf_section"),
        "sector_label",
        F.explode(F.sequence(F.col("division_min").cast("int"), F.col("division_max").cast("int"))).alias("n"),
    ).select(F.lpad(F.col("n").cast("string"), 2, "0").alias(division), "naf_section", "sector_label")
    return df.join(F.broadcast(codes), division, "left").fillna(
        {"naf_section": UNKNOWN_SECTION, "sector_label": UNKNOWN_SECTOR}
    )


def sector_usage(spark: SparkSession, clients: DataFrame) -> DataFrame:
    """Every section with the number of clients classified in it."""
    coded = clients.withColumn("naf_division", F.left("naf_code", F.lit(2)))
    used = sector_lookup(coded, "naf_division").groupBy("naf_section").agg(F.count(F.lit(1)).alias("clients"))
    return (
        sector_ref(spark)
        .join(used, F.col("section_code") == F.col("naf_section"), "left")
        .drop("naf_section")
        .fillna(0, ["clients"])
    )


def _name_of(names: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index)


def calendar_dim(days: DataFrame, day: str = "day") -> DataFrame:
    """Calendar attributes of a frame of days (Monday = 0)."""
    weekday, month = F.weekday(day), F.month(day)
    holiday = (month * 100 + F.dayofmonth(day)).isin(*[m * 100 + d for m, d in FIXED_HOLIDAYS])
    return days.select(
        F.col(day).alias("date_id"),
        weekday.alias("weekday"),
        _name_of(DAY_NAMES, weekday + 1).alias("weekday_name"),
        F.weekofyear(day).alias("iso_week"),
        month.alias("month"),
        _name_of(MONTH_NAMES, month).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (~weekday.isin(5, 6) & ~holiday).alias("is_working_day"),
        holiday.alias("is_holiday"),
    )


def day_series(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day of a fixed range (the default calendar is 2020-01-01 … 2035-12-31)."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))


def spanned_days(df: DataFrame, column: str) -> DataFrame:
    """One row per day between the first and the last date of a table."""
    span = df.agg(F.to_date(F.min(column)).alias("first"), F.to_date(F.max(column)).alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("day"))
