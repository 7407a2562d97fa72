"""All registered queries: name → (session, data folder) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.catalog import GOLD, runner
from tallyhouse.plans.daily_catalog import DAILY, Daily
from tallyhouse.plans.incremental_catalog import INCREMENTAL, Incremental
from tallyhouse.plans.semantic_catalog import SEMANTIC
from tallyhouse.plans.silver_catalog import SILVER, Silver

QueryFunction = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFunction]:
    gold = {name: runner(build) for name, build in GOLD.items()}
    silver = {name: runner(build, Silver) for name, build in SILVER.items()}
    reports = {name: runner(build) for name, build in SEMANTIC.items()}
    incremental = {name: runner(build, Incremental) for name, build in INCREMENTAL.items()}
    daily = {name: runner(build, Daily) for name, build in DAILY.items()}
    return {**gold, **silver, **reports, **incremental, **daily}
