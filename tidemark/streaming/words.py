"""Word streams: the running repair of times as a stateful operator, and windowed word rates with late data bounded by a watermark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "source_id long, idx long, word string, start_ms long, end_ms long"


def repair_stream(words: DataFrame, least_ms: int = 10) -> DataFrame:
    """Words (source_id, idx, word, start_ms, end_ms) with times made monotonic as they arrive.

    The state of a source is the end of its last word. Words of one batch are taken by
    ordinal; one that arrives after a later word is repaired against that one.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values("idx", kind="stable")
        last = state.get[0] if state.exists else 0
        # less the row's share of least_ms, ends are a running maximum
        share = least_ms * np.arange(1, len(rows) + 1)
        raw = np.maximum(rows["end_ms"], rows["start_ms"] + least_ms).to_numpy() - share
        end = share + np.maximum.accumulate(np.maximum(raw, last))
        before = np.concatenate([[last], end[:-1]])
        state.update((int(end[-1]),))
        yield rows.assign(start_ms=np.maximum(rows["start_ms"].to_numpy(), before), end_ms=end)[["source_id", "idx", "word", "start_ms", "end_ms"]]

    return words.select("source_id", "idx", "word", "start_ms", "end_ms").groupBy("source_id").applyInPandasWithState(step, OUT, "last long", "append", GroupStateTimeout.NoTimeout)


def event_rates(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n) by tumbling windows of events (ts, event_type); events later than `late` are left out."""
    own = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return own.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
