import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import (
    bucketize,
    change_hash,
    code_or_null,
    composite_id,
    concat_skip_null,
    grain,
    hours_between,
    key_hash,
    month_days,
    null_if_blank,
    ratio,
    round_to,
    safe_bool,
    salted_hash,
)
from tallyhouse.plans.gold.clients import churn_label, churn_score


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("value", "expected"), [(None, None), ("", None), ("  ", None), (" a ", "a")]
)
def test_null_if_blank(spark, value, expected):
    assert one(spark, null_if_blank(F.lit(value).cast("string"))) == expected


def test_codes(spark):
    assert one(spark, code_or_null(F.lit(" 00012 "), 5)) == "00012"
    assert one(spark, code_or_null(F.lit("123"), 5)) is None
    assert one(spark, composite_id(F.lit("123456789"), 9, F.lit("00012"), 5)) == "12345678900012"
    assert one(spark, composite_id(F.lit("1234"), 9, F.lit("00012"), 5)) is None


@pytest.mark.parametrize(("value", "expected"), [("1", True), ("true", True), ("0", False), ("maybe", False), (None, False)])
def test_safe_bool(spark, value, expected):
    assert one(spark, safe_bool(F.lit(value).cast("string"))) is expected


def test_hashes(spark):
    salt = "a-salt-of-some-length"
    expected = hashlib.sha256(("1850578006084" + salt).encode()).hexdigest()
    hashed = one(spark, salted_hash(F.lit("1850578006084"), salt))
    assert hashed == expected and len(hashed) == 64
    assert one(spark, salted_hash(F.lit(""), salt)) is None
    assert one(spark, salted_hash(F.lit(None).cast("string"), salt)) is None
    assert one(spark, salted_hash(F.lit("1850578006084"), "another-salt-entirely")) != expected
    assert one(spark, key_hash(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == hashlib.md5(b"a|b").hexdigest()
    null, blank = F.lit(None).cast("string"), F.lit("")
    assert one(spark, change_hash([null])) != one(spark, change_hash([blank]))
    pairs = [("a|b", "c"), ("a", "b|c"), ("1:a", "-"), ("", "1:a-"), (None, "a"), ("-", "a")]
    hashes = [one(spark, change_hash([F.lit(a).cast("string"), F.lit(b).cast("string")])) for a, b in pairs]
    assert len(set(hashes)) == len(pairs)
    assert one(spark, concat_skip_null(F.lit("a"), null, F.lit("b"))) == "ab"


@pytest.mark.parametrize(
    ("hours", "label"), [(None, "inconnu"), (-3, "urgent"), (24, "urgent"), (25, "court"), (72, "court"), (168, "standard"), (169, "long")]
)
def test_bucketize(spark, hours, label):
    steps = ((24, "urgent"), (72, "court"), (168, "standard"))
    assert one(spark, bucketize(F.lit(hours).cast("int"), steps, "long", "inconnu")) == label


def test_hour_boundaries(spark):
    def hours(a, b):
        return one(spark, hours_between(F.lit(a).cast("timestamp"), F.lit(b).cast("timestamp")))

    assert hours(datetime(2026, 1, 1, 10, 59), datetime(2026, 1, 1, 11, 1)) == 1
    assert hours(datetime(2026, 1, 1, 10, 0), datetime(2026, 1, 1, 10, 59)) == 0
    assert hours(datetime(2026, 1, 1, 11, 1), datetime(2026, 1, 1, 10, 59)) == -1


def test_dates(spark):
    assert one(spark, grain(F.lit(date(2026, 3, 15)), "week")) == date(2026, 3, 9)
    assert one(spark, grain(F.lit(date(2026, 3, 15)), "quarter")) == date(2026, 1, 1)
    assert one(spark, month_days(F.lit(date(2024, 2, 1)))) == 29


def test_ratio_and_rounding(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, ratio(F.lit(1), F.lit(0), 2, 0.0)) == 0.0
    assert one(spark, ratio(F.lit(Decimal("2")), F.lit(3), 4)) == 0.6667
    assert one(spark, round_to(F.lit(-2.5), 0)) == -3.0


@pytest.mark.parametrize(
    ("days", "qoq", "quarters", "expected"),
    [
        (181, None, 4, "PERDU"), (180, None, 4, "HIGH"), (91, None, 4, "HIGH"), (90, None, 4, "MEDIUM"),
        (46, None, 4, "MEDIUM"), (45, None, 4, "LOW"), (10, -0.40, 4, "MEDIUM"), (10, -0.30, 4, "LOW"),
        (10, None, 1, "MEDIUM"), (10, 0.2, 4, "LOW"),
    ],
)
def test_churn_label(spark, days, qoq, quarters, expected):
    label = churn_label(F.lit(days), F.lit(qoq).cast("double"), F.lit(quarters))
    assert one(spark, label) == expected


def test_churn_score(spark):
    def score(days, qoq, quarters, yoy):
        return one(
            spark, churn_score(F.lit(days), F.lit(qoq).cast("double"), F.lit(quarters), F.lit(yoy).cast("double"))
        )

    assert score(365, -1.0, 0, -1.0) == 1.0
    assert score(0, None, 4, None) == 0.0
    assert 0.0 <= score(60, -0.1, 2, 0.3) <= score(120, -0.1, 2, 0.3) <= 1.0
