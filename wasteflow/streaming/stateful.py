"""Plateaus over a stream of checks: state of each series, timers that wait for late checks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def plateau_stream(checks: DataFrame, n: int = 5, least: float = 500_000, enough: float = 850_000, late: str = "0 seconds") -> DataFrame:
    """series, at, n, run, plateau of a stream of (series string, at timestamp, n long): the rows of plateau_detect, each once.

    Checks wait in the state of their series until the watermark (the latest time seen less `late`) reaches them, and go
    out in the order of their times, however they are dealt over micro-batches. Checks that come later than the watermark
    are dropped, as are those without a time or count. Of checks at one time the smaller count comes first. State of a
    series: the last count, the length of its run and the waiting checks.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, run, times, counts = state.get if state.exists else (None, 0, [], [])
        waiting = list(zip(times, counts))
        for f in frames:
            waiting += zip(f["us"].tolist(), f["n"].tolist())
        waiting.sort()
        reached = state.getCurrentWatermarkMs() * 1000
        out = []
        while waiting and waiting[0][0] <= reached:
            at, count = waiting.pop(0)
            run = run + 1 if count == last else 1
            last = count
            out.append((key[0], at, count, run, (run >= n and count > least) or count > enough))
        state.update((last, run, [w[0] for w in waiting], [w[1] for w in waiting]))
        if waiting:
            # A timer fires when the watermark is beyond its time.
            state.setTimeoutTimestamp(max(-(-waiting[0][0] // 1000) - 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["series", "us", "n", "run", "plateau"])

    rows = checks.where("at is not null and n is not null").select("series", "at", F.unix_micros("at").alias("us"), "n").withWatermark("at", late)
    out = rows.groupBy("series").applyInPandasWithState(step, "series string, us long, n long, run int, plateau boolean", "last long, run int, times array<long>, counts array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select("series", F.timestamp_micros("us").alias("at"), "n", "run", "plateau")
