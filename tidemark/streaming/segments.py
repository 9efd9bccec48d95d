"""Windows and cues of word streams: a stateful operator whose timers close what the watermark has passed."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.sequences import cue_step, window_step

OUT = "source_id long, number long, from_idx long, to_idx long, start_ms long, end_ms long, text string"
#: Transform-with-state keeps its state in this store; the session must name it before the stream starts.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Segments(StatefulProcessor):
    """Segments of each source's words, as a fold closes them.

    The state of a source is what the watermark has not passed yet, and the open segment. A word is taken once the watermark
    has passed its time, so that none before it can come any more, and once the next word is there, whose gap it needs; the
    timer of `quiet` ms behind the last word takes that without a next one and closes the segment.
    """

    def __init__(self, step: Callable, quiet: int):
        self.step, self.quiet = step, quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "state string")

    def _state(self) -> dict:
        return json.loads(self.held.get()[0]) if self.held.exists() else {"waiting": [], "taken": -1, "number": -1, "inner": None, "open": None}

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state, passed = self._state(), timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            state["waiting"] += [[int(r.idx), r.word, int(r.start_ms), int(r.end_ms), int(r.ms)] for r in frame.itertuples() if r.ms >= passed]
        times = [w[4] for w in state["waiting"]]
        yield from self._taken(key, state, passed)
        if times:
            for at in {max(times), max(times) + self.quiet}:
                self.handle.registerTimer(at)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._taken(key, self._state(), timerValues.getCurrentWatermarkInMs())

    def _taken(self, key: tuple, state: dict, passed: int) -> Iterator[pd.DataFrame]:
        """The segments that end with words whose time has passed, and whose next word's or `quiet` ms more."""
        own = sorted(w for w in state["waiting"] if w[4] <= passed and w[0] > state["taken"])
        later, done = [w for w in state["waiting"] if w[4] > passed], []
        for k, (idx, word, start, end, ms) in enumerate(own):
            following = own[k + 1] if k + 1 < len(own) else None
            final = following is None or following[4] - ms > self.quiet
            if following is None and ms + self.quiet > passed:
                later.append(own[k])
                break
            inner = tuple(state["inner"]) if isinstance(state["inner"], list) else state["inner"]
            if inner is None:
                state["number"] += 1
                state["open"] = {"from": idx, "start": start, "words": []}
            inner = self.step(inner, start, end, 0 if final else following[2] - end, final, word)
            state["open"]["words"].append(word or "")
            state["inner"], state["taken"] = inner, idx
            if inner is None or final:
                o = state["open"]
                done.append((key[0], state["number"], o["from"], idx + 1, o["start"], end, " ".join(o["words"])))
                state["inner"] = state["open"] = None
        state["waiting"] = later
        self.held.update((json.dumps(state),))
        if done:
            yield pd.DataFrame(done, columns=["source_id", "number", "from_idx", "to_idx", "start_ms", "end_ms", "text"])

    def close(self) -> None:
        pass


def _segment_stream(words: DataFrame, step: Callable, late: str, quiet_ms: int) -> DataFrame:
    spark = words.sparkSession
    if spark.conf.get(STORE[0]) != STORE[1]:
        raise ValueError(f"set {STORE[0]} to {STORE[1]} for this stream")
    own = words.select("source_id", "idx", "word", "start_ms", "end_ms", "ts", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return own.withWatermark("ts", late).groupBy("source_id").transformWithStateInPandas(Segments(step, quiet_ms), OUT, "Append", "EventTime")


def cue_stream(words: DataFrame, late: str = "10 seconds", quiet_ms: int = 60_000, pause: int = 350, chars: int = 62, span: int = 4000) -> DataFrame:
    """Caption cues of words (source_id, idx, word, start_ms, end_ms, ts) as they arrive: those of operators/sequences.py, each once the watermark has passed its last word's time.

    Words that come later than `late` behind the latest are left out, as is one whose ordinal is behind one already taken. A
    source that is quiet for `quiet_ms` of event time ends its cue; words that follow begin another.
    """
    return _segment_stream(words, cue_step(pause, chars, span), late, quiet_ms)


def window_stream(words: DataFrame, late: str = "10 seconds", quiet_ms: int = 60_000, least: int = 8000, target: int = 10000, most: int = 12000, pause: int = 1000) -> DataFrame:
    """Semantic windows of words as they arrive, with their `id`; see cue_stream() for late words and quiet sources."""
    out = _segment_stream(words, window_step(least, target, most, pause), late, quiet_ms)
    return out.withColumn("id", F.format_string("window-%04d", F.col("number") + 1))
