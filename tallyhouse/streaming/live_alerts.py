"""Missing-declaration alerts as a live stream that repairs itself.

A start that has no declaration in the hours before it is held for a while, in case its declaration is still on the way; then
an alert is raised.  If the declaration comes later after all, the alert is withdrawn.  Both are rows of an append-only log; the
alerts that stand are those raised and not withdrawn (`standing`), and equal the batch anti join over all events whatever
the order in which they came.

State lies by (key, time slot): a declaration goes to its own slot and the next one, a start to its own, so one busy key spreads over
slots and a state holds the few events of some hours.  Timers run on the clock, not on event time: a watermark would drop the
late events that withdrawals are made of.  States are dropped `keep` after their last event.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyhouse.streaming.alerts import WINDOW_HOURS, _slot

RAISED, WITHDRAWN = "raised", "withdrawn"
LOG = "key long, event_id long, started_at timestamp, change string"
STATE = "started array<long>, ids array<long>, raised array<boolean>, declared array<long>"
DAY_MS = 24 * 3600 * 1000


def events(starts: DataFrame, declarations: DataFrame, key: str, hours: int = WINDOW_HOURS) -> DataFrame:
    """Starts (key, started_at, event_id) and declarations (key, declared_at) of one stream, by key and slot."""
    begun = starts.select(
        F.col(key).alias("key"), _slot(F.col("started_at"), hours).alias("slot"), "event_id", F.unix_micros("started_at").alias("at")
    )
    own = _slot(F.col("declared_at"), hours)
    declared = declarations.select(
        F.col(key).alias("key"),
        F.explode(F.array(own, own + 1)).alias("slot"),
        F.lit(None).cast("long").alias("event_id"),
        F.unix_micros("declared_at").alias("at"),
    )
    return begun.unionByName(declared)


def watch(rows: DataFrame, hours: int = WINDOW_HOURS, hold_ms: int = 60_000, keep_ms: int = 400 * DAY_MS) -> DataFrame:
    """The log of a stream of `events`."""
    width = hours * 3600 * 1_000_000

    def step(group: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        started, ids, raised, declared = (list(part) for part in state.get) if state.exists else ([], [], [], [])
        log: list[tuple[int, int, str]] = []

        def missing(at: int) -> bool:
            return not any(at - width <= d <= at for d in declared)

        if state.hasTimedOut:
            if all(raised) or not any(missing(at) and not up for at, up in zip(started, raised, strict=True)):
                state.remove()
                return
            for i, at in enumerate(started):
                if not raised[i] and missing(at):
                    raised[i] = True
                    log.append((ids[i], at, RAISED))
            state.update((started, ids, raised, declared))
            state.setTimeoutDuration(keep_ms)
        else:
            for batch in batches:
                for event, at in zip(batch["event_id"], batch["at"], strict=True):
                    if pd.isna(event):
                        declared.append(int(at))
                    else:
                        started.append(int(at))
                        ids.append(int(event))
                        raised.append(False)
            for i, at in enumerate(started):
                if raised[i] and not missing(at):
                    raised[i] = False
                    log.append((ids[i], at, WITHDRAWN))
            waits = any(missing(at) and not up for at, up in zip(started, raised, strict=True))
            state.update((started, ids, raised, declared))
            state.setTimeoutDuration(hold_ms if waits else keep_ms)
        if log:
            yield pd.DataFrame(
                {
                    "key": group[0],
                    "event_id": [event for event, _, _ in log],
                    "started_at": pd.to_datetime([at for _, at, _ in log], unit="us"),
                    "change": [change for _, _, change in log],
                }
            )

    return rows.groupBy("key", "slot").applyInPandasWithState(step, LOG, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def start_watch(log: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append the log to a table: all events that are there now, then timers until the query is stopped."""
    writer = log.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def run_until_quiet(query: StreamingQuery, hold_ms: int, patience: float = 600.0) -> None:
    """Let a watch take all events that are there and fire their timers, then stop it.

    Timers on the clock fire in batches without data, of which such a query runs one after another; two of them that began
    after the hold have fired all.
    """
    deadline, empty, since = time.monotonic() + patience, None, 0.0
    while query.isActive and time.monotonic() < deadline:
        last = query.lastProgress
        if last is not None and last["numInputRows"]:
            empty = None
        elif last is not None and empty is None:
            empty, since = last["batchId"], time.monotonic()
        elif empty is not None and last["batchId"] >= empty + 3 and time.monotonic() > since + hold_ms / 1000:
            break
        time.sleep(0.05)
    failed = query.exception()
    query.stop()
    if failed is not None:
        raise failed


def standing(log: DataFrame) -> DataFrame:
    """Alerts raised and not withdrawn."""
    turns = F.sum(F.when(F.col("change") == RAISED, 1).otherwise(-1))
    return log.groupBy("key", "event_id", "started_at").agg(turns.alias("n")).filter("n > 0").drop("n")
