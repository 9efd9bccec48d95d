"""Operators over per-frame tracks: filling between anchors, smoothing, runs of weak frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators import carry, folds
from tidemark.operators.folds import fold, reduced


def interpolate(samples: DataFrame) -> DataFrame:
    """(source_id, shot_id, frame, cx, confidence): a value for every sampled frame, from the anchors of its shot.

    Before the first anchor it holds the first, from the last on the last with its own confidence;
    between two it lies on their line with the lesser confidence. cx is in thousandths, rounded down.
    """
    anchor = F.when(F.col("cx").isNotNull(), F.struct("frame", "cx", "confidence"))
    own = carry.neighbours(samples.withColumn("__at", anchor), ["source_id", "shot_id"], ["frame"], "__at")
    between = F.col("prev.cx") * 1000 + F.expr("(next.cx - prev.cx) * 1000 * (frame - prev.frame) div (next.frame - prev.frame)")
    case = lambda none, first, last, mid: F.when(F.col("final").isNull(), none).when(F.col("prev").isNull(), first).when(F.col("frame") >= F.col("final.frame"), last).otherwise(mid)
    cx = case(F.lit(None).cast("long"), F.col("next.cx") * 1000, F.col("final.cx") * 1000, between)
    confidence = case(F.lit(0).cast("long"), F.col("next.confidence"), F.col("final.confidence"), F.least("prev.confidence", "next.confidence"))
    return own.select("source_id", "shot_id", "frame", cx.alias("cx"), confidence.alias("confidence"))


def _anchored(shots: DataFrame, samples: DataFrame) -> DataFrame:
    """(source_id, shot_id, first, last, prev, next, final): stretches of frames between anchors, see carry.stretches()."""
    kind = "struct<frame:bigint,cx:bigint,cy:bigint,h:bigint,confidence:double,detector:string>"
    anchor = F.struct(F.col("frame").cast("long"), ((F.col("x0") + F.col("x1")) * 500).cast("long"), ((F.col("y0") + F.col("y1")) * 500).cast("long"), ((F.col("y1") - F.col("y0")) * 1000).cast("long"), F.col("confidence").cast("double"), "detector").cast(kind)
    found = samples.where("x0 is not null").select("source_id", "shot_id", F.col("frame").cast("long").alias("frame"), anchor.alias("anchor"))
    extents = shots.where("end_frame > start_frame").select("source_id", "shot_id", F.col("start_frame").cast("long").alias("first"), (F.col("end_frame").cast("long") - 1).alias("last"))
    return carry.stretches(found, extents, ["source_id", "shot_id"], "frame", "anchor")


def _by_place(none, first, last, mid):
    """What holds in a stretch without anchors in its shot, before the first, behind the last, and between two."""
    return F.when(F.col("final").isNull(), none).when(F.col("prev").isNull(), first).when(F.col("next").isNull(), last).otherwise(mid)


def _confidence():
    """The confidence of a stretch's frames before the last anchor, and from it on (null where the stretch lies before it)."""
    return _by_place(F.lit(0.0), F.col("next.confidence"), F.col("final.confidence"), F.least("prev.confidence", "next.confidence")), F.when(F.col("prev").isNotNull(), F.col("final.confidence"))


def _flags(confidence):
    return F.when(confidence > 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("no-detection")))


def record_stretches(shots: DataFrame, samples: DataFrame) -> DataFrame:
    """(source_id, shot_id, frame, last_frame, confidence, flags): what frame_records() gives, for stretches of frames that have it in common.

    There are as many as samples and shots, whatever the frames between them.
    """
    before, behind = _confidence()
    since = F.when(F.col("prev").isNotNull(), F.col("final.frame"))
    # the frames up to the last anchor's and those from it on have confidences of their own
    part = lambda first, last, confidence: F.struct(first.alias("frame"), last.alias("last_frame"), F.round(confidence, 4).alias("confidence"))
    parts = F.array(part(F.col("first"), F.least(F.col("last"), since - 1), before), part(F.when(since.isNotNull(), F.greatest(F.col("first"), since)), F.col("last"), behind))
    own = _anchored(shots, samples).select("source_id", "shot_id", F.inline(parts)).where("frame <= last_frame")
    return own.withColumn("flags", _flags(F.col("confidence")))


def frame_records(shots: DataFrame, samples: DataFrame, width: int, height: int, by_shot: bool = False) -> DataFrame:
    """One record for every frame of every shot: (source_id, shot_id, frame, cx, cy, box_height, confidence, flags, detector).

    shots are (source_id, shot_id, start_frame, end_frame), samples (source_id, shot_id, frame, x0, y0, x1, y1, confidence, detector)
    with a null box where nothing was found. Positions are in thousandths. Up to the first anchor the first holds, from the last on the
    last with its own confidence; between two a frame lies on their line with the lesser confidence and the earlier one's detector.
    A shot without anchors has the source's centre, no box, and a flag, as have frames without confidence.

    Samples and shots are dealt and sorted, frames are made where the stretch between two samples lies. `by_shot` deals the stretches
    by shot first, so that what goes along shots next does not deal the frames.
    """
    # what a stretch's frames share is worked out once a stretch: where its line starts, how far and how long it goes, and what holds from the last anchor on
    fixed = lambda c, none: _by_place(F.lit(none).cast("long"), F.col(f"next.{c}"), F.col(f"final.{c}"), F.col(f"prev.{c}")).alias(f"__{c}")
    change = lambda c: F.when(F.col("prev").isNull() | F.col("next").isNull(), 0).otherwise(F.col(f"next.{c}") - F.col(f"prev.{c}")).alias(f"__change_{c}")
    from_last = lambda c: F.when(F.col("prev").isNotNull(), F.col(f"final.{c}")).alias(f"__final_{c}")
    before, behind = _confidence()
    held = _anchored(shots, samples).select(
        "source_id", "shot_id", "first", "last", *(f(c) for c in ("cx", "cy", "h") for f in (change, from_last)), fixed("cx", width * 500), fixed("cy", height * 500), fixed("h", None),
        F.coalesce("prev.frame", F.lit(0)).alias("__since"), F.coalesce(F.col("next.frame") - F.col("prev.frame"), F.lit(1)).alias("__over"), from_last("frame"), behind.alias("__final_confidence"), from_last("detector"),
        before.alias("__confidence"), _by_place(F.lit("center"), F.col("next.detector"), F.col("final.detector"), F.col("prev.detector")).alias("__detector"),
    )
    if by_shot:
        held = held.repartition("source_id", "shot_id")
    every = held.withColumn("frame", F.explode(F.sequence("first", "last")))
    last = F.col("frame") >= F.col("__final_frame")
    value = lambda c: F.when(last, F.col(f"__final_{c}")).otherwise(F.expr(f"__{c} + __change_{c} * (frame - __since) div __over"))
    confidence = F.round(F.when(last, F.col("__final_confidence")).otherwise(F.col("__confidence")), 4)
    detector = F.when(last, F.col("__final_detector")).otherwise(F.col("__detector"))
    return every.select("source_id", "shot_id", "frame", value("cx").alias("cx"), value("cy").alias("cy"), value("h").alias("box_height"), confidence.alias("confidence"), _flags(confidence).alias("flags"), detector.alias("detector"))


def static_records(totals: DataFrame, cx: int, cy: int) -> DataFrame:
    """One record for every frame of sources (source_id, total) whose subject is known to stay at (cx, cy), in thousandths."""
    frames = totals.where("total > 0").select("source_id", F.lit("shot-001").alias("shot_id"), F.explode(F.expr("sequence(0L, cast(total as bigint) - 1)")).alias("frame"))
    return frames.select("*", F.lit(cx).cast("long").alias("cx"), F.lit(cy).cast("long").alias("cy"), F.lit(None).cast("long").alias("box_height"), F.lit(1.0).alias("confidence"), F.array().cast("array<string>").alias("flags"), F.lit("static").alias("detector"))


def weak_ranges(records: DataFrame, least: float) -> DataFrame:
    """(source_id, start_frame, end_frame): runs of frames with confidence under `least` or with any of `flags` (where there is such a column); a run may cross shots and ends at the next strong frame.

    A record is a frame, or stands for all from `frame` to `last_frame` where there is such a column.
    """
    weak = F.coalesce("confidence", F.lit(0)) < least
    if "flags" in records.columns:
        weak = weak | (F.size(F.coalesce("flags", F.array().cast("array<string>"))) > 0)
    own = carry.runs(records.withColumn("__weak", weak), ["source_id"], "frame", "__weak", until="last_frame" if "last_frame" in records.columns else None)
    return own.select("source_id", F.col("start").alias("start_frame"), F.col("end").alias("end_frame"))


def smooth(track: DataFrame, window: int = 5, name: str = "cx") -> DataFrame:
    """The rows of a track with the centred window's sum as `total` (the ends repeated beyond the edges) and the `width` that divides it.

    The window is made odd, and no wider than the shot is long.
    """
    return _smoothed(track, {name: window}).withColumnsRenamed({f"__total_{name}": "total", f"__width_{name}": "width"})


def _smoothed(track: DataFrame, windows: dict[str, int]) -> DataFrame:
    """track with `__total_c` and `__width_c` of each column c and its window, all in one way through the rows.

    A window's sum is the difference of two running sums: as far ahead and behind in every shot that is long enough; a short
    one's are looked up in a list, which the window bounds. So it costs as much whatever the window is.
    """
    order = W.partitionBy("source_id", "shot_id").orderBy("frame")
    whole, upto = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing), order.rowsBetween(W.unboundedPreceding, 0)
    n, i = F.col("__n"), F.col("__i")
    own = track.withColumns({"__n": F.count("*").over(whole), "__i": F.row_number().over(order), **{f"__{k}_{c}": v for c in windows for k, v in (("first", F.first(c).over(whole)), ("last", F.last(c).over(whole)), ("sum", F.sum(F.coalesce(c, F.lit(0))).over(upto)))}})
    most = {c: max(1, w) + (max(1, w) % 2 == 0) for c, w in windows.items()}  # the width in shots that have as many frames
    looks = {}
    for c, m in most.items():
        total = F.col(f"__sum_{c}")
        looks |= {f"__ahead_{c}": F.lead(total, m // 2).over(order), f"__behind_{c}": F.lag(total, m // 2 + 1).over(order), f"__all_{c}": F.last(total).over(whole), f"__sums_{c}": F.collect_list(F.when(n < m, total)).over(whole)}
    own = own.withColumns(looks)
    for c, m in most.items():
        width = F.when(n >= m, m).otherwise(F.greatest(F.lit(1), n - F.when(n % 2 == 0, 1).otherwise(0))).cast("long")
        r, at = F.floor(width / 2), lambda k, c=c: F.get(f"__sums_{c}", (k - 1).cast("int"))
        ahead = F.coalesce(F.when(n >= m, F.col(f"__ahead_{c}")).otherwise(at(F.least(i + r, n))), F.col(f"__all_{c}"))
        behind = F.coalesce(F.when(n >= m, F.col(f"__behind_{c}")).otherwise(at(i - r - 1)), F.lit(0))
        edges = F.greatest(F.lit(0), r + 1 - i) * F.col(f"__first_{c}") + F.greatest(F.lit(0), i + r - n) * F.col(f"__last_{c}")
        own = own.withColumns({f"__total_{c}": (ahead - behind + edges).cast("long"), f"__width_{c}": width})
    return own.drop("__n", "__i", *(f"__{k}_{c}" for c in windows for k in ("first", "last", "sum", "ahead", "behind", "all", "sums")))


def fill(track: DataFrame, default: int) -> DataFrame:
    """(source_id, shot_id, frame, cx): missing values on the line between their neighbours by row, ends held, `default` where a shot has none. In thousandths."""
    order = W.partitionBy("source_id", "shot_id").orderBy("frame")
    own = track.withColumn("i", F.row_number().over(order))
    known = F.when(F.col("cx").isNotNull(), F.struct("i", "cx"))
    own = own.withColumn("a", F.last(known, True).over(order.rowsBetween(W.unboundedPreceding, 0))).withColumn("b", F.first(known, True).over(order.rowsBetween(0, W.unboundedFollowing)))
    line = F.expr("case when a is null and b is null then null when a is null then b.cx * 1000 when b is null or a.i = b.i then a.cx * 1000 else a.cx * 1000 + (b.cx - a.cx) * 1000 * (i - a.i) div (b.i - a.i) end")
    return own.select("source_id", "shot_id", "frame", F.coalesce(line, F.lit(default * 1000)).cast("long").alias("cx"))


def _held(least, most, before, v, radius: int):
    """The value before, within `radius` of v. These rules take least and most of whole numbers, or of arrays of them."""
    return least(most(before, v - radius), v + radius)


def _followed(least, most, at, speed, v, velocity: int, acceleration: int):
    """(value, speed) behind (at, speed)."""
    wanted = least(most(v - at, -velocity), velocity)
    speed = least(most(speed + least(most(wanted - speed, -acceleration), acceleration), -velocity), velocity)
    return at + speed, speed


def _folded(track: DataFrame, name: str, step) -> DataFrame:
    own = fold(track.select("source_id", "shot_id", "frame", name), ["source_id", "shot_id"], ["frame"], [name], "__out", LongType(), lambda: None, step)
    return own.select("source_id", "shot_id", "frame", F.col("__out").alias(name))


def dead_zone(track: DataFrame, radius: int, name: str = "cx", span: int | None = None) -> DataFrame:
    """The value holds while the input stays within `radius` of it, else follows at that distance.

    A row clamps the value before it, and clamps one after the other are a clamp: so chunks of a shot are folded side by
    side into one clamp each, those are folded along the shot, and every chunk is folded again from the value that it starts with.
    """
    keys, clamp = ["source_id", "shot_id"], StructType([StructField(c, LongType()) for c in ("low", "high", "alone")])
    own = carry.chunked(track.select(*keys, "frame", name), keys, "frame", span)

    def compose(state, v):
        if state is None:
            return {"low": v - radius, "high": v + radius, "alone": v}  # alone: what it ends with if the shot begins here
        return {c: _held(min, max, x, v, radius) for c, x in state.items()}

    def along(value, low, high, alone):
        return (alone if value is None else min(max(value, low), high)), value

    chunks = reduced(own.select("__chunk", *keys, "frame", name), [*keys, "__chunk"], ["frame"], [name], "m", clamp, lambda: None, compose).select(*keys, "__chunk", "m.*")
    starts = fold(chunks, keys, ["__chunk"], ["low", "high", "alone"], "__enter", LongType(), lambda: None, along).select(F.struct(*keys).alias("__key"), "__chunk", "__enter")

    def step(state, v, enter):
        before = enter if state is None else state
        held = v if before is None else _held(min, max, before, v, radius)
        return held, held

    entered = carry.joined(own, starts).withColumn("__chunk", carry.chunk_of("frame", span))
    out = fold(entered, [*keys, "__chunk"], ["frame"], [name, "__enter"], "__out", LongType(), lambda: None, step)
    return out.select(*keys, "frame", F.col("__out").alias(name))


def limit_motion(track: DataFrame, velocity: int, acceleration: int, name: str = "cx") -> DataFrame:
    """The value follows with at most `velocity` a row, which changes by at most `acceleration` a row; it starts at rest."""
    return _folded(track, name, lambda state, v: (now := _followed(min, max, *(state or (v, 0)), v, velocity, acceleration), now[0]))


def crop_track(samples: DataFrame, width: int, crop: int, window: int = 5, radius: int = 20_000, velocity: int = 60_000, acceleration: int = 25_000) -> DataFrame:
    """(source_id, shot_id, frame, cx, x): filled, smoothed, held in a dead zone and limited centres, and the crop's left edge inside the source; in thousandths."""
    smoothed = smooth(fill(samples, width // 2), window).select("source_id", "shot_id", "frame", F.expr("total div width").alias("cx"))

    def step(state, v):
        hold, at, speed = state or (v, v, 0)
        hold = _held(min, max, hold, v, radius)
        at, speed = _followed(min, max, at, speed, hold, velocity, acceleration)
        return (hold, at, speed), at

    moved = _folded(smoothed, "cx", step)  # the dead zone and the limits in one pass
    x = F.least(F.greatest(F.col("cx") - crop * 500, F.lit(0)), F.lit((width - crop) * 1000))
    return moved.withColumn("x", x.cast("long"))


def crop_frames(records: DataFrame, width: int, height: int, out_width: int, out_height: int, fps: int = 30, zoom: tuple[float, float] | None = None, subject_height: int | None = None) -> DataFrame:
    """A crop for every record of frame_records(): (source_id, shot_id, frame, x, y, width, height, zoom, and confidence and flags where records have them); pixels in thousandths, zoom in millionths.

    Both axes are smoothed over 0.35 s, held in a dead zone of 45 pixels (half of it upright) and limited to 1300 pixels a second,
    changing by 5200 a second. The crop is the largest of the wanted aspect, divided by the zoom, 4 % above the centre, inside the source.
    With `zoom` (least, most) it brings subjects to `subject_height`, else to the shot's median height (45 % of the source where there is none),
    smoothed over a second, at most 0.12 a second and 0.5 a second faster.
    """
    if out_width <= 0 or out_height <= 0:
        raise ValueError("output dimensions must be positive")
    least, most = (1.0, 1.0) if zoom is None else zoom
    if least < 1.0:
        raise ValueError("min_zoom must be at least 1.0")
    if most < least:
        raise ValueError("max_zoom must be greater than or equal to min_zoom")
    if subject_height is not None and subject_height <= 0:
        raise ValueError("target_subject_height must be positive")
    wide = width * out_height >= height * out_width
    native_w, native_h = (height * 1000 * out_width // out_height, height * 1000) if wide else (width * 1000, width * 1000 * out_height // out_width)
    low, high = round(least * 10**6), round(most * 10**6)
    keys, rest = ["source_id", "shot_id"], [c for c in ("confidence", "flags") if c in records.columns]
    odd = lambda n: max(1, n) + (max(1, n) % 2 == 0)
    windows = dict.fromkeys(("cx", "cy"), odd(round(0.35 * fps)))
    order = W.partitionBy(*keys).orderBy("frame")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    own = records.withColumns({"__i": F.row_number().over(order), "__n": F.count("*").over(whole)})
    if zoom is not None:
        known = F.when(F.col("box_height").isNotNull(), F.greatest("box_height", F.lit(1000)))
        # a percentile takes the order of the rest, so that the rows are sorted once
        wanted = F.lit(subject_height * 1000) if subject_height is not None else F.floor(F.coalesce(F.percentile(known, F.lit(0.5)).over(whole), F.lit(height * 450.0)))
        own = own.withColumn("__wanted", wanted.cast("long")).withColumn("__h", known)
        if subject_height is None:
            raw = F.expr(f"{low} * __wanted div __h")
        else:
            raw = F.expr("1000000 * __wanted div __h")
        own = own.withColumn("z", F.coalesce(F.least(F.greatest(raw, F.lit(low)), F.lit(high)), F.lit(low)).cast("long"))
        windows["z"] = odd(max(3, round(fps)))
    else:
        own = own.withColumn("z", F.lit(10**6).cast("long"))
    # positions and zoom move in thousandths of their units, so that rounding does not add up
    pan, pan_more = 1_300_000_000 // fps, 5_200_000_000 // fps**2
    grow, grow_more = 120_000_000 // fps, 500_000_000 // fps**2

    def begin(x, y, z):
        return 1000 * x, 1000 * y, 1000 * x, 0 * x, 1000 * y, 0 * y, 1000 * z, 0 * z

    def step(least, most, state, x, y, z):
        hx, hy, ax, sx, ay, sy, az, sz = state
        hx, hy = _held(least, most, hx, 1000 * x, 45_000_000), _held(least, most, hy, 1000 * y, 22_500_000)
        ax, sx = _followed(least, most, ax, sx, hx, pan, pan_more)
        ay, sy = _followed(least, most, ay, sy, hy, pan, pan_more)
        az, sz = _followed(least, most, az, sz, 1000 * z, grow, grow_more)
        return (hx, hy, ax, sx, ay, sy, az, sz), (ax // 1000, ay // 1000, least(most(az // 1000, low), high))

    def kernel(batches):
        smoothed = folds.averaged(batches, windows, "__i", "__n")
        return folds.stepped(smoothed, keys, ["cx", "cy", "z"], ["__x", "__y", "__z"], begin, step)

    own = folds.along(own.select(*keys, "frame", "cx", "cy", "z", *rest, "__i", "__n"), keys, ["frame"], [*keys, "frame", *rest], ["__x", "__y", "__z"], kernel)
    own = own.select(*keys, "frame", *rest, F.col("__x").alias("x"), F.col("__y").alias("y"), F.col("__z").alias("z")).withColumn("w", F.expr(f"{native_w}000000L div z")).withColumn("h", F.expr(f"{native_h}000000L div z"))
    x = F.least(F.greatest(F.expr("x - w div 2"), F.lit(0)), F.lit(width * 1000) - F.col("w"))
    y = F.least(F.greatest(F.expr("y - h * 4 div 100 - h div 2"), F.lit(0)), F.lit(height * 1000) - F.col("h"))
    return own.select("source_id", "shot_id", "frame", x.cast("long").alias("x"), y.cast("long").alias("y"), F.col("w").alias("width"), F.col("h").alias("height"), F.col("z").alias("zoom"), *rest)


def crop_lines(crops: DataFrame, fps: int) -> DataFrame:
    """(source_id, frame, line): a command for every crop, in thousandths, at its time; sources/documents.py writes them in frame order."""
    # whole numbers put together; a format string is read anew for every row
    number = lambda value, unit: F.concat(F.expr(f"{value} div {unit}").cast("string"), F.lit("."), F.lpad(F.expr(f"{value} % {unit}").cast("string"), len(str(unit)) - 1, "0"))
    nanos = f"((2000000000L * frame + {fps}) div {2 * fps})"
    line = F.concat(number(nanos, 10**9), F.lit(" crop w "), number("width", 1000), F.lit(", crop h "), number("height", 1000), F.lit(", crop x "), number("x", 1000), F.lit(", crop y "), number("y", 1000), F.lit(";"))
    return crops.select("source_id", "frame", line.alias("line"))


def canvas_transforms(crops: DataFrame, out_width: int, out_height: int) -> DataFrame:
    """(source_id, frame, scale, dx, dy, error): how each crop fills a canvas; an error where its aspect is another."""
    sx, sy = F.lit(float(out_width)) / (F.col("width") / 1000.0), F.lit(float(out_height)) / (F.col("height") / 1000.0)
    own = crops.withColumn("sx", sx).withColumn("sy", sy)
    return own.select("source_id", "frame", F.col("sx").alias("scale"), (-(F.col("x") / 1000.0) * F.col("sx")).alias("dx"), (-(F.col("y") / 1000.0) * F.col("sy")).alias("dy"), F.when(F.abs(F.col("sx") - F.col("sy")) > 0.001, "Crop aspect does not match the canvas").alias("error"))


#: What can be wrong with a crop, in the order in which it is named.
CROP_ERRORS = ("non-positive crop", "crop origin outside source", "crop exceeds source bounds", "crop aspect does not match output")


def track_errors(crops: DataFrame, videos: DataFrame, out_width: int | None = None, out_height: int | None = None, width: int | None = None, height: int | None = None) -> DataFrame:
    """(source_id, passed, errors) of crop frames (source_id, frame, x, y, width, height) against videos (source_id, w, h, total): order, count, and the first offending frame.

    Without an output's size, each video has its own (out_width, out_height). Where all sources have one size (width, height), videos
    need no w and h, and crops are summed up where they lie; else a track's rows are dealt once, for the join with their video and the sums.
    """
    aspect = F.col("out_width") / F.col("out_height") if out_width is None else F.lit(out_width / out_height)
    w, h = (F.col("w"), F.col("h")) if width is None else (F.lit(width), F.lit(height))
    wrong = (
        (F.col("width") <= 0) | (F.col("height") <= 0),
        (F.col("x") < -0.5) | (F.col("y") < -0.5),
        (F.col("x") + F.col("width") > w + 0.5) | (F.col("y") + F.col("height") > h + 0.5),
        F.abs(F.col("width") / F.col("height") - aspect) > 0.01,
    )
    own = crops if width is not None and out_width is not None else crops.join(videos, "source_id")
    own = own.withColumn("rule", F.coalesce(*(F.when(test, k) for k, test in enumerate(wrong))))
    # 64 frames are one row of sums, whose bits say which are there: whole numbers only, and so many times fewer rows to deal than frames
    firsts = [f"__first_{k}" for k in range(len(wrong))]
    own = own.groupBy("source_id", F.expr("shiftright(cast(frame as bigint), 6)").alias("__block")).agg(
        F.min("frame").alias("least"), F.max("frame").alias("most"), F.count("*").alias("n"), F.expr("bit_or(shiftleft(1L, cast(cast(frame as bigint) & 63 as int)))").alias("__bits"),
        *(F.min(F.when(F.col("rule") == k, F.col("frame"))).alias(c) for k, c in enumerate(firsts)),
    )
    sums = own.groupBy("source_id").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n"), F.coalesce(F.sum(F.bit_count("__bits")), F.lit(0)).alias("d"), *(F.min(c).alias(c) for c in firsts))
    sums = sums.withColumn("at", F.least(*firsts)).withColumn("rule", F.coalesce(*(F.when(F.col(c) == F.col("at"), text) for c, text in zip(firsts, CROP_ERRORS))))
    both = videos.join(sums, "source_id", "left")
    errors = F.when(F.col("n").isNull(), F.array(F.lit("no frame records"))).otherwise(F.array_compact(F.array(
        F.when((F.col("d") < F.col("n")) | (F.col("most") - F.col("least") + 1 != F.col("n")), "frame records are not continuous"),
        F.when(F.col("least") != 0, "frame records must start at 0"),
        F.when(F.col("n") != F.col("total"), F.format_string("expected %d records, found %d", "total", "n")),
        F.when(F.col("rule").isNotNull(), F.format_string("frame %d: %s", "at", "rule")),
    )))
    return both.select("source_id", (F.size(errors) == 0).alias("passed"), F.array_join(errors, "; ").alias("errors"))
