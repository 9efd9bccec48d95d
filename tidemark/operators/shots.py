"""Cuts and shots: cut points from log lines, shots between accepted cuts, sampled frames, frames placed in shots, stills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tidemark.operators import carry
from tidemark.operators.folds import fold


def cuts_from_log(lines: DataFrame, fps: int) -> DataFrame:
    """(source_id, frame) of lines (source_id, line_no, line): a `scene_score` line fires at the time that the last line with `pts_time:` gave, once.

    A later time replaces an earlier one and a firing clears it, so a firing line's
    predecessor among these lines decides. Times are exact decimals; halves go to even frames.
    """
    kind = F.when(F.col("line").contains("pts_time:"), "time").when(F.col("line").contains("scene_score"), "fire")
    own = lines.withColumn("kind", kind).where("kind is not null")
    t = F.expr(r"try_cast(nullif(regexp_extract(line, 'pts_time:[ ]*([0-9.]+)', 1), '') as decimal(18,3))")
    own = carry.before(own.withColumn("t", F.when(F.col("kind") == "time", t)), ["source_id"], "line_no", {"armed": F.col("t")})
    frame = F.bround(F.col("armed") * fps, 0).cast("long")
    return own.where("kind = 'fire' and armed is not null").select("source_id", frame.alias("frame")).where("frame > 0").distinct()


def build_shots(cuts: DataFrame, totals: DataFrame, least: int = 12) -> DataFrame:
    """(source_id, shot_id, start_frame, end_frame): shots tile [0, total); a cut counts if `least` frames lie since the last one that counted, and so many follow.

    A fold over a source's distinct cuts, whose state is the last one that counted.
    """
    own = cuts.join(totals, "source_id").where("frame < total").select("source_id", "frame", "total").distinct()
    step = lambda held, frame: (frame, True) if frame - held >= least else (held, False)
    taken = fold(own, ["source_id"], ["frame"], ["frame"], "taken", BooleanType(), int, step).where("taken")
    final = F.max("frame").over(W.partitionBy("source_id"))
    taken = taken.withColumn("final", final).where(f"frame <> final or total - frame >= {least}")
    points = totals.where("total > 0").select("source_id", F.lit(0).cast("long").alias("start_frame"), "total").union(taken.select("source_id", "frame", "total"))
    order = W.partitionBy("source_id").orderBy("start_frame")
    end = F.coalesce(F.lead("start_frame").over(order), F.col("total"))
    return points.select("source_id", F.format_string("shot-%03d", F.row_number().over(order)).alias("shot_id"), "start_frame", end.alias("end_frame"))


def sample_frames(totals: DataFrame, shots: DataFrame, every: int) -> DataFrame:
    """(source_id, frame): every so many frames, the last one, and the first of each shot."""
    stride = F.explode(F.expr(f"array_union(sequence(0L, total - 1, {max(1, every)}L), array(total - 1))"))
    return totals.where("total > 0").select("source_id", stride.alias("frame")).union(shots.select("source_id", "start_frame")).distinct()


def place_frames(frames: DataFrame, shots: DataFrame) -> DataFrame:
    """(source_id, frame, shot_id): the shot that holds each frame; `shot-001` where none does. Shots don't overlap, so it is an as-of lookup in one sorted pass."""
    marks = shots.select("source_id", F.col("start_frame").alias("frame"), F.struct("shot_id", "end_frame").alias("shot"), F.lit(0).alias("kind"))
    asked = frames.select("source_id", "frame", F.lit(None).cast(marks.schema["shot"].dataType).alias("shot"), F.lit(1).alias("kind"))
    order = W.partitionBy("source_id").orderBy("frame", "kind").rowsBetween(W.unboundedPreceding, 0)
    own = marks.union(asked).withColumn("shot", F.last("shot", True).over(order)).where("kind = 1")
    return own.select("source_id", "frame", F.when(F.col("frame") < F.col("shot.end_frame"), F.col("shot.shot_id")).otherwise("shot-001").alias("shot_id"))


def stills(shots: DataFrame) -> DataFrame:
    """(source_id, shot_id, role, frame): the first, middle and last frame of every shot."""
    roles = F.array(
        F.struct(F.lit("first").alias("role"), F.col("start_frame").alias("frame")),
        F.struct(F.lit("middle").alias("role"), F.expr("start_frame + (end_frame - start_frame - 1) div 2").alias("frame")),
        F.struct(F.lit("last").alias("role"), (F.col("end_frame") - 1).alias("frame")),
    )
    return shots.select("source_id", "shot_id", F.inline(roles))


def still_crops(stills: DataFrame, crops: DataFrame) -> DataFrame:
    """Stills (source_id, shot_id, role, frame) with the crop of their frame; those without one go."""
    return stills.join(crops.drop("shot_id"), ["source_id", "frame"])


def sampled_detections(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """Sampled frames (source_id, frame) with what was found there; null where nothing was."""
    return frames.join(detections, ["source_id", "frame"], "left")
