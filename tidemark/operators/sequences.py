"""Operators over ordered words: validation, repair of times, segmentation into windows and cues, rebasing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.operators import carry
from tidemark.operators.folds import fold


def _order():
    return W.partitionBy("source_id").orderBy("idx")


def _word_errors(words: DataFrame, total_ms: Column | None) -> DataFrame:
    timed = F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull()
    own = carry.neighbours(words.withColumn("__timed", F.when(timed, F.struct("start_ms", "end_ms"))), ["source_id"], ["idx"], "__timed")
    own = own.withColumn("ps", F.col("prev.start_ms")).withColumn("pe", F.col("prev.end_ms"))
    errors = F.array_compact(F.array(
        F.when(F.regexp_replace(F.coalesce("word", F.lit("")), r"\s+", "") == "", "blank word"),
        F.when(~timed, "times must be finite"),
        F.when(timed & ((F.col("start_ms") < 0) | (F.col("end_ms") <= F.col("start_ms"))), "invalid range"),
        F.when(timed & ((F.col("start_ms") < F.col("ps")) | (F.col("end_ms") < F.col("pe"))), "not monotonic"),
        F.when(timed & (F.col("end_ms") > total_ms + 250), "beyond the source") if total_ms is not None else F.lit(None).cast("string"),
    ))
    return own.select("source_id", "idx", F.posexplode(errors).alias("check", "error"))


def word_errors(words: DataFrame, total_ms: Column | None = None) -> DataFrame:
    """(source_id, idx, error): words without text, and times that are missing, not ordered inside a word or against the last word with times, or beyond the source's end by over 250 ms."""
    return _word_errors(words, total_ms).drop("check")


#: Errors of a transcript that its report shows.
SHOWN = 20


def transcript_errors(words: DataFrame, total_ms: Column | None = None, shown: int = SHOWN) -> DataFrame:
    """(source_id, n_errors, errors): how many errors a source's words have, and the first ones in order, joined; sources without any are left out."""
    found = _word_errors(words, total_ms)
    counts = found.groupBy("source_id").agg(F.count("*").alias("n_errors"))
    first = found.withColumn("place", F.row_number().over(W.partitionBy("source_id").orderBy("idx", "check"))).where(F.col("place") <= shown)
    text = F.format_string("word %d: %s", "idx", "error")
    lists = first.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("place", text.alias("text")))).alias("list"))
    joined = counts.withColumnRenamed("source_id", "s").join(lists, F.col("s").eqNullSafe(F.col("source_id")))
    return joined.select("source_id", "n_errors", F.array_join(F.transform("list", lambda x: x["text"]), "; ").alias("errors"))


def repair(words: DataFrame, least_ms: int = 10) -> DataFrame:
    """Times made monotonic: a start is at least the end before, an end at least `least_ms` behind its start.

    The running repair has a closed form: less the ordinal's share, ends are a running maximum. `idx` counts a source's words from 0.
    """
    share = F.lit(least_ms) * (F.col("idx") + 1)
    raw = F.greatest("end_ms", F.col("start_ms") + least_ms) - share
    own = carry.running_max(words, ["source_id"], "idx", raw, "__most")
    end = share + F.greatest(F.lit(0), F.col("__most"))
    last = F.when(F.col("idx") > 0, share - least_ms + F.greatest(F.lit(0), F.col("__most_before"))).otherwise(0)
    return own.select("source_id", "idx", "word", F.greatest("start_ms", last).cast("long").alias("start_ms"), end.cast("long").alias("end_ms"))


def _segments(words: DataFrame, step) -> DataFrame:
    """(source_id, number, from_idx, to_idx, start_ms, end_ms, text): segments whose words a fold over each source numbers.

    `step(state, start, end, gap, last, word)` sees the state that it gave before, None at a segment's first word, and gives None where the segment ends.
    """
    gap = F.coalesce(F.lead("start_ms").over(_order()) - F.col("end_ms"), F.lit(0))
    own = words.withColumn("gap", gap).withColumn("last", F.lead("idx").over(_order()).isNull())

    def numbered(state, *row):
        number, inner = state
        number += inner is None
        inner = step(inner, *row)
        return (number, inner), number

    own = fold(own, ["source_id"], ["idx"], ["start_ms", "end_ms", "gap", "last", "word"], "number", LongType(), lambda: (-1, None), numbered)
    first, last = F.min_by("start_ms", "idx"), F.max_by("end_ms", "idx")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "word"))), lambda x: x["word"]), " ")
    return own.groupBy("source_id", "number").agg(F.min("idx").alias("from_idx"), (F.max("idx") + 1).alias("to_idx"), first.alias("start_ms"), last.alias("end_ms"), text.alias("text"))


def window_step(least: int, target: int, most: int, pause: int):
    """The fold that closes a window at `most` ms, or past `least` at a sentence end or pause, or past `target` at a short gap."""

    def step(start, begin, end, gap, last, word):
        start = begin if start is None else start
        past = end - start
        ends = past >= most or (past >= least and ((word or "")[-1:] in (".", "?", "!") or gap >= pause)) or (past >= target and gap >= 350)
        return None if ends else start

    return step


def semantic_windows(words: DataFrame, least: int = 8000, target: int = 10000, most: int = 12000, pause: int = 1000) -> DataFrame:
    """Windows that close at `most` ms, or past `least` at a sentence end or pause, or past `target` at a short gap; with their `id`."""
    return _segments(words, window_step(least, target, most, pause)).withColumn("id", F.format_string("window-%04d", F.col("number") + 1))


_SENTENCE_END = re.compile(r"""[.?!]["')\]]*$""")


def cue_step(pause: int, chars: int, span: int):
    """The fold that closes a cue at a sentence end (quotes may follow), else at a pause, else at length or duration."""

    def step(state, begin, end, gap, last, word):
        start, n = (begin, -1) if state is None else state
        n += 1 + len(word or "")
        ends = bool(_SENTENCE_END.search(word or "")) or (not last and gap >= pause) or n >= chars or end - start >= span
        return None if ends else (start, n)

    return step


def cues(words: DataFrame, pause: int = 350, chars: int = 62, span: int = 4000) -> DataFrame:
    """Caption cues: they break at a sentence end (quotes may follow), else at a pause, else at length or duration."""
    return _segments(words, cue_step(pause, chars, span))


def rebase(words: DataFrame, clips: DataFrame, bucket_ms: int = 60_000) -> DataFrame:
    """Words that overlap clips (source_id, clip_id, clip_start, clip_end), in clip-local time.

    A range join by time buckets: both sides name the buckets they touch, and a pair counts in the bucket of its later start.
    """
    buckets = lambda a, b: F.explode(F.sequence(F.floor(a / bucket_ms), F.floor(F.greatest(a, b - 1) / bucket_ms)))
    w = words.withColumn("bucket", buckets(F.col("start_ms"), F.col("end_ms")))
    c = clips.withColumn("bucket", buckets(F.col("clip_start"), F.col("clip_end")))
    both = w.join(c, ["source_id", "bucket"]).where("end_ms > clip_start and start_ms < clip_end").where(F.floor(F.greatest("start_ms", "clip_start") / bucket_ms) == F.col("bucket"))
    return both.select("source_id", "clip_id", "word", F.greatest(F.lit(0), F.col("start_ms") - F.col("clip_start")).alias("start_ms"), (F.least("end_ms", "clip_end") - F.col("clip_start")).alias("end_ms"), F.col("idx").alias("parent_idx"), F.col("start_ms").alias("parent_start_ms"), F.col("end_ms").alias("parent_end_ms"))


def _frame(ms, fps: int, half: str):
    """Frame of a time in milliseconds: halves to the even frame ("even") or up ("up")."""
    return F.bround(ms * F.lit(fps).cast("decimal(6,0)") / F.lit(1000).cast("decimal(4,0)"), 0).cast("long") if half == "even" else F.floor((ms * fps * 2 + 1000) / 2000).cast("long")


def cue_frames(cues: DataFrame, totals: DataFrame, fps: int = 30, least: int = 8) -> DataFrame:
    """(source_id, number, start_frame, end_frame, text): each cue lasts to the next one's start (0.4 s for the last), `least` frames, and not beyond the source's total; cues left empty go."""
    order = W.partitionBy("source_id").orderBy("number")
    own = cues.select("source_id", "number", "text", _frame(F.col("start_ms"), fps, "even").alias("start_frame"), _frame(F.col("end_ms"), fps, "even").alias("own_end"))
    end = F.coalesce(F.lead("start_frame").over(order), F.col("own_end") + round(0.4 * fps))
    own = own.withColumn("end_frame", F.greatest(F.col("start_frame") + least, end)).join(totals, "source_id")
    own = own.withColumn("end_frame", F.least("end_frame", "total"))
    return own.where("start_frame < total and end_frame > start_frame").select("source_id", "number", "start_frame", "end_frame", "text")


def caption_pages(pages: DataFrame, show_from: int, hide_from: int, fps: int = 30, trim: int = 0, tail: int = 9) -> DataFrame:
    """(source_id, number, start_frame, end_frame): pages (start_ms, end_ms of the last token) stay until their words end and a tail, the next page, or `hide_from`; none shows before `show_from`."""
    order = W.partitionBy("source_id").orderBy("number")
    own = pages.select("source_id", "number", (_frame(F.col("start_ms"), fps, "up") - trim).alias("start"), (_frame(F.col("end_ms"), fps, "up") - trim).alias("spoken"))
    end = F.least(F.lit(hide_from), F.coalesce(F.lead("start").over(order), F.lit(hide_from)), F.col("spoken") + tail)
    out = own.select("source_id", "number", F.greatest("start", F.lit(show_from)).cast("long").alias("start_frame"), end.cast("long").alias("end_frame"))
    return out.where("end_frame > start_frame")


def caption_tokens(words: DataFrame) -> DataFrame:
    """(source_id, idx, token): words as caption tokens; all but a source's first begin with a blank."""
    return words.select("source_id", "idx", F.when(F.col("idx") == 0, F.col("word")).otherwise(F.concat(F.lit(" "), F.col("word"))).alias("token"))


def active_tokens(words: DataFrame, fps: int, every: int) -> DataFrame:
    """(source_id, frame, idx): the words that are spoken at every so many frames: from their start on and before their end.

    A word names its frames itself, so there is no join.
    """
    first = lambda ms: F.ceil(ms * fps / (1000 * every)).cast("long")  # noqa: E731  of the frames 0, every, 2 * every, ... the first at or behind a time
    own = words.withColumn("a", F.greatest(F.lit(0), first(F.col("start_ms")))).withColumn("z", first(F.col("end_ms"))).where("z > a")
    return own.select("source_id", F.explode(F.transform(F.sequence(F.col("a"), F.col("z") - 1), lambda f: f * every)).alias("frame"), "idx")
