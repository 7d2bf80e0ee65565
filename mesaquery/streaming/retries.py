"""A stream of work to be tried again, from a stream of results: the next method, after a growing pause."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = "tried string, attempts int, done boolean, due long"
_OUT = "method string, attempt int, due timestamp"


def due_retries(results: DataFrame, key: str, at: str, usable: str, method: str, methods: Sequence[str], pause: str = "1 hour", late: str = "0 seconds") -> DataFrame:
    """key, method, attempt, due: what is to be tried once the stream's time has come to ``due``.

    A key with a usable result is done for good. After a failure the first of ``methods`` that wasn't
    tried yet follows, ``pause`` later, and twice as long after each further one; a result that comes
    in between moves it. Keys whose methods have all failed aren't tried again. Each key's state is a
    row in the state store, so that a stopped stream goes on with its timers; time is that of the
    results' watermark, ``late`` behind the newest.
    """
    wait = int(pd.Timedelta(pause).total_seconds() * 1000)

    def follow(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tried, attempts, done, due = state.get if state.exists else ("", 0, False, 0)
        known = [m for m in tried.split("\n") if m]
        left = [m for m in methods if m not in known]
        if state.hasTimedOut:
            state.update((tried, attempts, done, 0))
            if left and not done:
                yield pd.DataFrame({key: [keys[0]], "method": [left[0]], "attempt": [attempts + 1], "due": [pd.Timestamp(due, unit="ms")]})
            return
        newest = 0
        for batch in batches:
            for _, row in batch.iterrows():
                done = done or bool(row["usable"])
                if not row["usable"]:
                    attempts += 1
                if row["method"] and row["method"] not in known:
                    known.append(row["method"])
                newest = max(newest, int(row["at"].value // 1_000_000))
        left = [m for m in methods if m not in known]
        if left and not done:
            due = max(newest + wait * 2 ** (attempts - 1), state.getCurrentWatermarkMs() + 1)
            state.setTimeoutTimestamp(due)
        state.update(("\n".join(known), attempts, done, due))

    kind = dict(results.dtypes)[key]
    rows = results.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    rows = rows.select(key, F.col(at).alias("at"), F.coalesce(F.col(usable), F.lit(False)).alias("usable"), F.coalesce(F.col(method), F.lit("")).alias("method"))
    return rows.groupBy(key).applyInPandasWithState(follow, f"`{key}` {kind}, {_OUT}", _STATE, "append", GroupStateTimeout.EventTimeTimeout)
