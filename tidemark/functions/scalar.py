"""Row-local functions over half-open ranges, scores and ids."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Score weights (they total 1) and the flags that block a candidate.
WEIGHTS = {"hook": "0.30", "self_contained": "0.20", "emotion": "0.15", "payoff": "0.20", "retention": "0.15"}
SCORE_NAMES = {"hook": "hook", "self_contained": "selfContainedness", "emotion": "emotion", "payoff": "payoffDensity", "retention": "retention"}
BLOCKING = ("midSentence", "missingPayoff", "requiresPriorContext")


def composite(weights: dict[str, str] = WEIGHTS) -> Column:
    """Exact weighted sum, half up at three decimals; the weights must total exactly 1."""
    if sum(map(Decimal, weights.values())) != 1:
        raise ValueError("weights must total 1")
    total = sum((F.col(n) * F.lit(w).cast("decimal(3,2)") for n, w in weights.items()), F.lit(0).cast("decimal(4,1)"))
    return F.round(total, 3).cast("decimal(8,3)")


def stable_id(source: Column, start: Column, end: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", source.cast("string"), start.cast("string"), end.cast("string")), 256), 1, 12)


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Frames that two ranges share."""
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def score_error(weights: dict[str, str] = WEIGHTS) -> Column:
    """What is wrong with the first score, in the order of the weights, that is missing or not in 0 to 10; null if none is."""
    wrong = lambda c: F.when(F.col(c).isNull(), f"score {SCORE_NAMES.get(c, c)} is missing").when((F.col(c) < 0) | (F.col(c) > 10), f"score {SCORE_NAMES.get(c, c)} must be between 0 and 10")
    return F.coalesce(*map(wrong, weights))


def range_errors(minimum: float, maximum: float, weights: dict[str, str] = WEIGHTS) -> Column:
    """Reasons to reject a candidate, in order; a bad range is the only reason given. Limits are seconds at the source's own `fps`."""
    seconds = F.try_divide((F.col("end_frame") - F.col("start_frame")).cast("double"), F.col("fps"))
    blocked = F.array_sort(F.array_distinct(F.array_intersect("flags", F.array(*map(F.lit, BLOCKING)))))
    reasons = F.array_compact(F.array(
        F.when(seconds < minimum, "below minimum duration"),
        F.when(seconds > maximum, "above maximum duration"),
        F.when(F.size(blocked) > 0, F.concat(F.lit("blocking flags: "), F.array_join(blocked, ", "))),
        score_error(weights),
        F.when(F.regexp_replace(F.coalesce("topic_key", F.lit("")), r"\s+", "") == "", "topicKey is required"),
    ))
    bad = F.col("start_frame").isNull() | F.col("end_frame").isNull() | (F.col("start_frame") < 0) | (F.col("end_frame") <= F.col("start_frame"))
    return F.when(bad, F.array(F.lit("invalid half-open frame range"))).otherwise(reasons)


def seconds_to_frame(seconds: Column, fps: str, mode: str = "nearest") -> Column:
    """Exact decimal product as a frame: "nearest" (halves up), "floor" or "ceil"."""
    product = seconds.cast("decimal(20,6)") * F.lit(fps).cast("decimal(10,5)")
    return {"nearest": lambda x: F.round(x, 0), "floor": F.floor, "ceil": F.ceil}[mode](product).cast("long")


def supplied_or(own: Column, fallback: Column) -> Column:
    """A supplied text if it holds any, else the fallback."""
    return F.coalesce(F.nullif(own, F.lit("")), fallback)


def first_nonzero(*values: Column) -> Column:
    """The first value that is neither null nor 0."""
    return F.coalesce(*(F.nullif(v, F.lit(0)) for v in values))


def orientation(width: Column, height: Column) -> Column:
    return F.when(height > width, "vertical").when(width > height, "horizontal").otherwise("square")


def minutes_estimate(minutes: Column) -> Column:
    """A struct (least, most): whole minutes that transcribing takes, halves to even, 1 and 2 at least."""
    return F.struct(F.greatest(F.lit(1), F.bround(minutes * 0.15, 0).cast("long")).alias("least"), F.greatest(F.lit(2), F.bround(minutes * 0.25, 0).cast("long")).alias("most"))


def scaled(size: int, height: Column) -> Column:
    """A type size drawn for 1920 lines, for a canvas of `height`; halves to even."""
    return F.bround(F.lit(float(size)) * (height / 1920), 0).cast("long")


def hook_opacity(frame: Column, hold: Column, ramp: int = 8, fade: int = 12) -> Column:
    """Rises over the first `ramp` frames, falls over the last `fade` before `hold`, clamped at both ends; null where the two meet."""
    up, down = frame / ramp, (hold - frame) / fade
    return F.when(hold - fade > ramp, F.when(frame <= 0, 0.0).when(frame < ramp, up).when(frame <= hold - fade, 1.0).when(frame < hold, down).otherwise(0.0))


def framing_errors(out_width: Column, out_height: Column, least_zoom: Column, most_zoom: Column, subject_height: Column) -> Column:
    """The first thing wrong with the settings of a crop; null if nothing is. No subject height is fine."""
    return (
        F.when((out_width <= 0) | (out_height <= 0), "output dimensions must be positive")
        .when(least_zoom < 1, "min_zoom must be at least 1.0")
        .when(most_zoom < least_zoom, "max_zoom must be greater than or equal to min_zoom")
        .when(subject_height <= 0, "target_subject_height must be positive")
    )


def printed_rate(fps: Column) -> Column:
    """A rate as text, whole ones without decimals."""
    return F.when(fps % 1 == 0, fps.cast("long").cast("string")).otherwise(fps.cast("string"))
