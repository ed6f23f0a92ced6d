"""Polling as a stream: timers tell when a target falls due, by the clocks of its attempts and not by their arrival."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DUE = "target_id long, due_us long"


def due_stream(attempts: DataFrame, interval_us: int, late: str = "0 seconds") -> DataFrame:
    """(target_id, due_us), appended once the watermark has passed: together what due_times gives up to the watermark.

    attempts: target_id, ts. State is the last settled attempt of a target and those ahead of the watermark; a timer stands
    at the next of them or at the instant when the target falls due. It survives restarts with its checkpoint.
    """

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, told, ahead = state.get if state.exists else (None, False, [])
        ahead = set(ahead)
        if not state.hasTimedOut:
            for f in frames:
                ahead |= {int(x) for x in f["us"]}
        mark, due = state.getCurrentWatermarkMs() * 1000, []
        for us in sorted(u for u in ahead if u <= mark):  # what is settled comes in order, as nothing older is let in
            if last is not None and not told and last + interval_us < us:
                due.append(last + interval_us)
            last, told = us, False
        if last is not None and not told and last + interval_us <= mark:
            due.append(last + interval_us)
            told = True
        ahead = sorted(u for u in ahead if u > mark)
        state.update((last, told, ahead))
        wait = ahead[:1] + ([last + interval_us] if last is not None and not told else [])
        if wait:
            state.setTimeoutTimestamp(max(min(wait) // 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({"target_id": [int(key[0])] * len(due), "due_us": due}, dtype="int64")

    rows = attempts.withWatermark("ts", late).select("target_id", "ts", F.unix_micros("ts").alias("us"))
    return rows.groupBy("target_id").applyInPandasWithState(update, DUE, "last long, told boolean, ahead array<long>", "append", GroupStateTimeout.EventTimeTimeout)
