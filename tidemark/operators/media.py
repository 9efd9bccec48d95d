"""Checks of rendered media: rates, sizes, frame counts, levels, loudness, black stretches; each gives a finding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import first_nonzero

#: Limits in dB, LUFS and dBTP.
SILENCE_DB, LOUDNESS_LEAST, LOUDNESS_MOST, PEAK_MOST, EDGE_DB = -60, -16, -8, -0.1, 8


def rate(text: Column) -> Column:
    """Frames a second of "num/den" or a number; 0 for what is neither."""
    number = lambda i: F.try_element_at(F.split(text, "/"), F.lit(i)).try_cast("double")
    whole = F.when(text.contains("/"), F.try_divide(number(1), number(2))).otherwise(text.try_cast("double"))
    return F.coalesce(whole, F.lit(0.0))


def crop_size(width: Column, height: Column, out_width: int, out_height: int) -> Column:
    """A struct (width, height) of doubles: the largest rectangle of the wanted aspect."""
    wide = width * out_height >= height * out_width
    return F.struct(F.when(wide, height * out_width / out_height).otherwise(width.cast("double")).alias("width"), F.when(wide, height.cast("double")).otherwise(width * out_height / out_width).alias("height"))


def _finding(check: str, status: Column, detail: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), status.alias("status"), detail.alias("detail"))


def _passes(condition: Column, otherwise: str) -> Column:
    return F.when(condition, "pass").otherwise(otherwise)


def expected_spec(asked: Column, timeline: Column, stage: Column) -> Column:
    """A struct (width, height, fps, frames) of what is expected of a medium: what is `asked` for, else what its contract's `timeline` says; 0 and null ask for nothing.

    At the stage `source` a timeline's `materialized` part, where there is one, stands for the timeline; only the number of
    frames falls back to the timeline's end.
    """
    own = F.when((stage == "source") & timeline["materialized"].isNotNull(), timeline["materialized"]).otherwise(F.struct(*(timeline[c].alias(c) for c in ("width", "height", "fps", "totalFrames"))))
    same = lambda c: first_nonzero(asked[c], own[c]).alias(c)
    return F.struct(same("width"), same("height"), same("fps"), first_nonzero(asked["frames"], own["totalFrames"], timeline["endFrameExclusive"]).alias("frames"))


def spec_findings(media: DataFrame, key: str) -> DataFrame:
    """(key, check, status, detail) of media (streams, width, height, rate, frames, duration; want_width, want_height, want_fps, want_frames, null or 0: no expectation).

    streams are structs (codec_type, codec_name); a medium without a video stream has one finding.
    """
    fps = rate(F.col("rate"))
    size = F.format_string("%dx%d", "width", "height")
    asked = (F.coalesce("want_width", F.lit(0)) != 0) & (F.coalesce("want_height", F.lit(0)) != 0)
    same = (F.col("width") == F.col("want_width")) & (F.col("height") == F.col("want_height"))
    shown = F.format_string("%.3f", fps)
    asked_fps, asked_frames = F.coalesce("want_fps", F.lit(0.0)) != 0, F.coalesce("want_frames", F.lit(0)) != 0
    frames = F.coalesce("frames", F.lit(0))
    near, upright = F.abs(frames - F.col("want_frames")) <= 1, F.col("height") > F.col("width")
    codecs = F.array_join(F.transform("streams", lambda x: F.concat_ws(":", x["codec_type"], F.coalesce(x["codec_name"], F.lit("None")))), ", ")
    checks = F.array(
        _finding("dimensions", _passes(~asked | same, "fail"), F.when(~asked, F.concat(size, F.lit(" (no expectation supplied)"))).when(same, size).otherwise(F.format_string("expected %dx%d, rendered %dx%d", "want_width", "want_height", "width", "height"))),
        _finding("orientation", _passes(upright, "warn"), F.when(upright, "vertical").otherwise(F.concat(F.lit("not vertical: "), size))),
        _finding("fps", _passes(~asked_fps | (F.abs(fps - F.col("want_fps")) < 0.05), "fail"), F.when(~asked_fps, F.concat(shown, F.lit(" (no expectation supplied)"))).when(F.abs(fps - F.col("want_fps")) < 0.05, shown).otherwise(F.concat(F.lit("expected "), F.col("want_fps").cast("double").cast("string"), F.lit(", rendered "), shown))),
        _finding("frame-count", _passes(~asked_frames | near, "fail"), F.when(~asked_frames | near, frames.cast("string")).otherwise(F.format_string("expected %d, rendered %d", F.col("want_frames"), frames))),
        _finding("duration", F.lit("pass"), F.format_string("%.3fs", F.coalesce("duration", F.lit(0.0)))),
        _finding("codecs", F.lit("pass"), codecs),
    )
    none = F.array(_finding("video-stream", F.lit("fail"), F.lit("no video stream found")))
    return media.select(key, F.inline(F.when(F.exists("streams", lambda x: x["codec_type"] == "video"), checks).otherwise(none)))


def logged_levels(logs: DataFrame) -> DataFrame:
    """logs (audio_log, loudness_log, head_log, tail_log, freeze_log, decode_log and more) with what they say: mean_db, lufs, peak, has_loudness, readable, head_db, tail_db, freezes, decode_errors; null: not measured."""
    level = lambda c: F.regexp_extract(c, r"mean_volume:\s*(-?[0-9.]+) dB", 1).try_cast("double")
    blocks = F.regexp_extract_all("loudness_log", F.lit(r'\{[^{}]*"input_i"[^{}]*\}'), F.lit(0))
    last = F.try_element_at(blocks, F.lit(-1))
    measured = F.from_json(last, "input_i string, input_tp string, broken string", {"columnNameOfCorruptRecord": "broken"})
    lines = F.filter(F.split(F.coalesce("decode_log", F.lit("")), "\n"), lambda x: F.trim(x) != "")
    return logs.withColumns({
        "mean_db": level("audio_log"), "head_db": level("head_log"), "tail_db": level("tail_log"),
        "has_loudness": F.size(blocks) > 0, "readable": measured["broken"].isNull() & measured["input_i"].isNotNull(), "lufs": measured["input_i"].try_cast("double"), "peak": measured["input_tp"].try_cast("double"),
        "freezes": F.regexp_extract_all("freeze_log", F.lit(r"freeze_start:\s*([0-9.]+)"), F.lit(1)), "decode_errors": F.size(lines),
    })


def level_findings(media: DataFrame, key: str, window: float = 0.15) -> DataFrame:
    """(key, check, status, detail) of logged_levels(), and whether there is audio (`has_audio`), at the clip's `duration`.

    A clip's first and last moments should lie `EDGE_DB` below its own mean level: a cut at speech level may lie inside a word.
    """
    audio = F.col("has_audio")
    silent = F.col("mean_db") <= SILENCE_DB
    mean = F.format_string("%.1f", "mean_db")
    audio_level = _finding("audio-level", F.when(F.col("mean_db").isNull(), "warn").when(silent, "fail").otherwise("pass"), F.when(F.col("mean_db").isNull(), "could not measure mean volume").when(silent, F.concat(F.lit("silent: "), mean, F.lit(" dB mean"))).otherwise(F.concat(mean, F.lit(" dB mean"))))
    good = F.col("lufs").between(LOUDNESS_LEAST, LOUDNESS_MOST)
    lufs = F.format_string("%.1f", "lufs")
    unread = F.when(~F.col("has_loudness"), "could not measure loudness").when(~F.col("readable"), "loudness output was not parseable")
    loudness = _finding("loudness", F.when(unread.isNull() & good, "pass").otherwise("warn"), F.coalesce(unread, F.when(good, F.concat(lufs, F.lit(" LUFS integrated"))).otherwise(F.concat(lufs, F.lit(f" LUFS, not in {LOUDNESS_LEAST:.1f} to {LOUDNESS_MOST:.1f}")))))
    over = F.col("peak") > PEAK_MOST
    peak = F.when(unread.isNull(), _finding("true-peak", F.when(over, "fail").otherwise("pass"), F.when(over, F.concat(F.format_string("%.2f", "peak"), F.lit(f" dBTP, over {PEAK_MOST}"))).otherwise(F.concat(F.format_string("%.2f", "peak"), F.lit(" dBTP")))))
    short, unknown = F.coalesce("duration", F.lit(0.0)) <= 4 * window, F.col("mean_db").isNull()

    def edge(name: str, position: str, verb: str) -> Column:
        value = F.col(f"{name}_db")
        clean = value <= F.col("mean_db") - EDGE_DB
        db = F.format_string("%.1f", value)
        said = F.when(value.isNull(), "could not measure").when(clean, F.concat(db, F.lit(" dB, mean "), mean, F.lit(" dB")))
        loud = F.concat(db, F.lit(f" dB in the {position} {window}s, mean "), mean, F.lit(f" dB: may {verb} inside a word"))
        return F.when(~short & ~unknown, _finding(f"boundary-{name}", F.when(clean, "pass").otherwise("warn"), F.coalesce(said, loud)))

    whole = F.when(short | unknown, _finding("boundaries", F.lit("warn"), F.when(short, "too short for its edges").otherwise("mean level unknown")))
    n = F.col("decode_errors")
    decode = _finding("decode", F.when(n == 0, "pass").otherwise("fail"), F.when(n == 0, "every frame decoded cleanly").otherwise(F.format_string("%d decode error(s)", n)))
    frozen = F.size("freezes")
    freeze = _finding("frozen-frames", F.when(frozen == 0, "pass").otherwise("warn"), F.when(frozen == 0, "none detected").otherwise(F.format_string("%d frozen stretch(es) of 1s or longer", frozen)))
    heard = F.array(audio_level, loudness, peak, whole, edge("head", "first", "start"), edge("tail", "last", "end"))
    none = F.array(_finding("audio-present", F.lit("fail"), F.lit("no audio stream")))
    return media.select(key, F.inline(F.array_compact(F.concat(F.array(decode, freeze), F.when(audio, heard).otherwise(none)))))


def black_ranges(logs: DataFrame, key: str) -> DataFrame:
    """(key, status, n_ranges, ranges) of log texts (key, log): black stretches at the head fail, others warn; the first five are shown."""
    pattern = r"black_start:([0-9.]+) black_end:([0-9.]+)"
    starts, ends = F.regexp_extract_all("log", F.lit(pattern), F.lit(1)), F.regexp_extract_all("log", F.lit(pattern), F.lit(2))
    own = logs.select(key, starts.alias("a"), ends.alias("b"))
    head = F.exists("a", lambda x: x.try_cast("double") < 0.5)
    shown = F.array_join(F.transform(F.slice(F.arrays_zip("a", "b"), 1, 5), lambda p: F.concat(p["a"], F.lit("-"), p["b"])), ", ")
    return own.select(key, F.when(F.size("a") == 0, "pass").when(head, "fail").otherwise("warn").alias("status"), F.size("a").cast("long").alias("n_ranges"), shown.alias("ranges"))


def largest(boxes: DataFrame, key: str, order: str) -> DataFrame:
    """The box (x0, y0, x1, y1) of largest area of each key; the first in `order` on ties."""
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    # a struct's maximum needs one pass and combines before the shuffle
    best = F.max(F.struct(area.alias("area"), (-F.col(order)).alias("k"), "x0", "y0", "x1", "y1")).alias("m")
    return boxes.groupBy(key).agg(best).select(key, "m.area", (-F.col("m.k")).alias(order), "m.x0", "m.y0", "m.x1", "m.y1")


def heaviest(boxes: DataFrame, key: str, weight: str, order: str) -> DataFrame:
    """The box of the largest weight of each key, the first in `order` on ties, with a confidence of half its weight in 0 to 1."""
    best = F.max(F.struct(F.col(weight).alias("w"), (-F.col(order)).alias("k"), "x0", "y0", "x1", "y1")).alias("m")
    confidence = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("m.w") / 2.0))
    return boxes.groupBy(key).agg(best).select(key, (-F.col("m.k")).alias(order), "m.x0", "m.y0", "m.x1", "m.y1", confidence.alias("confidence"))


def centre_box(width: Column, height: Column) -> Column:
    """The box that stands for "no detector": the middle of the frame, without confidence."""
    return F.struct((width * 0.3).alias("x0"), F.lit(0.0).alias("y0"), (width * 0.7).alias("x1"), height.cast("double").alias("y1"), F.lit(0.0).alias("confidence"), F.lit("center").alias("detector"))
