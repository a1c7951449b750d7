"""Live accumulators that are forgotten a fixed time after their last event.

A key's sums stay in the stream's state while events keep coming. ``state_hours`` after the last one an event-time timer removes the
state and tells the sink; a later event starts anew from zero. The gap between two events of a key is tested as well
when they meet in one micro-batch or before the timer could fire, so the result does not depend on how events fall into batches.
Late events, older than the watermark, are dropped by Spark before they reach the state.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hackstand.settings import DEFAULTS, Settings

FROM, TO, EXPIRED = "desde", "hasta", "expirado"


def accumulate(events: DataFrame, keys, moment: str, measures: dict[str, Column], settings: Settings = DEFAULTS, delay: str = "0 seconds") -> DataFrame:
    """Changed accumulators of a stream, for update mode: keys, ``measures`` (sums of longs), first and last event, whether it has expired.

    Grouping is by the keys' JSON, so that null keys and their types survive the way through Python. Only keys with new events or a
    due timer are touched in a micro-batch; their events arrive as Arrow batches.
    """
    ttl, names = settings.speed.state_hours * 3_600_000_000, list(measures)
    rows = events.select(F.to_json(F.struct(*keys)).alias("_key"), F.col(moment), F.unix_micros(moment).alias("_at"), *[c.cast("long").alias(n) for n, c in measures.items()])
    numbers = ", ".join(f"{n} long" for n in (*names, FROM, TO))
    grouped = rows.filter(F.col("_at").isNotNull()).withWatermark(moment, delay).groupBy("_key")
    changed = grouped.applyInPandasWithState(
        _updater(names, ttl), f"_key string, {numbers}, {EXPIRED} boolean", numbers, "update", GroupStateTimeout.EventTimeTimeout)
    shape = ", ".join(f"{k} {dict(events.dtypes)[k]}" for k in keys)
    return changed.select(F.from_json("_key", shape).alias("_k"), *names, F.timestamp_micros(FROM).alias(FROM), F.timestamp_micros(TO).alias(TO), EXPIRED).select(
        "_k.*", *names, FROM, TO, EXPIRED)


def _updater(names: list[str], ttl: int):
    def update(key: tuple, batches: Iterator, state: GroupState) -> Iterator:
        import numpy as np
        import pandas as pd

        columns = ["_key", *names, FROM, TO, EXPIRED]
        if state.hasTimedOut:
            gone = state.get
            state.remove()
            yield pd.DataFrame([(key[0], *gone, True)], columns=columns)
            return
        news = pd.concat(list(batches)).sort_values("_at", kind="stable")
        at, values = news["_at"].to_numpy(np.int64), news[names].fillna(0).to_numpy(np.int64)
        if state.exists:
            *sums, start, last = state.get
        else:
            sums, start, last = [0] * len(names), int(at[0]), int(at[0])
        # an event more than the time to live after the latest before it starts anew
        seen = np.maximum.accumulate(np.append(last, at))
        cuts = [0, *np.flatnonzero(at - seen[:-1] > ttl).tolist(), len(at)]
        out = []
        for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if n:
                out.append((key[0], *sums, start, last, True))
                sums, start, last = [0] * len(names), int(at[a]), int(at[a])
            if b > a:
                sums = [s + int(v) for s, v in zip(sums, values[a:b].sum(0))]
                start, last = min(start, int(at[a])), max(last, int(at[b - 1]))
        out.append((key[0], *sums, start, last, False))
        state.update((*sums, start, last))
        state.setTimeoutTimestamp((last + ttl) // 1000)
        yield pd.DataFrame(out, columns=columns)

    return update


def living(rows: DataFrame) -> DataFrame:
    """What a table of changed accumulators keeps: those that have not expired."""
    return rows.filter(~F.col(EXPIRED))
