"""Validate, score and rank candidates, suppress overlapping ones, pick a quota with soft topic diversity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.scalar import WEIGHTS, composite, range_errors, stable_id, supplied_or
from tidemark.operators.folds import fold
from tidemark.operators.intervals import Kept


def islands(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """df with `island`: ranges of different islands of one key never touch, so each can be handled by itself."""
    before = W.partitionBy(key).orderBy(start, end).rowsBetween(W.unboundedPreceding, -1)
    fresh = F.when(F.col(start) < F.max(end).over(before), 0).otherwise(1)
    return df.withColumn("__fresh", fresh).withColumn("island", F.sum("__fresh").over(W.partitionBy(key).orderBy(start, end).rowsBetween(W.unboundedPreceding, 0))).drop("__fresh")


def suppress(ranked: DataFrame, percent: int = 50) -> DataFrame:
    """`ranked` with greedy suppression in rank order per source: `suppressor` is the first kept row that overlaps by percent of the shorter range; null for kept rows.

    Only ranges of one island can overlap, so an island's rows, in rank order, are one fold; its state is an index of the kept ranges.
    """

    def step(kept: Kept, id_: str, start: int, end: int):
        suppressor = kept.first(start, end)
        if suppressor is None:
            kept.add(id_, start, end)
        return kept, suppressor

    own = islands(ranked, "source_id", "start_frame", "end_frame")
    return fold(own, ["source_id", "island"], ["position"], ["id", "start_frame", "end_frame"], "suppressor", StringType(), lambda: Kept(percent), step)


def rank(candidates: DataFrame, count: int = 5, minimum: float = 20, maximum: float = 60, percent: int = 50, diverse: bool = True, weights: dict[str, str] = WEIGHTS) -> DataFrame:
    """Every candidate with id, composite, rank (null unless selected), status and reasons.

    A supplied `id` wins over the stable one. Limits are seconds at `fps` (30 where there is no such column).
    """
    given = candidates if "fps" in candidates.columns else candidates.withColumn("fps", F.lit(30.0))
    stable = stable_id(F.col("source_id"), F.coalesce("start_frame", F.lit(-1)), F.coalesce("end_frame", F.lit(-1)))
    own = given.withColumn("id", supplied_or(F.col("id"), stable) if "id" in given.columns else stable).withColumn("errors", range_errors(minimum, maximum, weights))
    own = own.withColumn("composite", F.when(F.size("errors") == 0, composite(weights)))
    order = W.partitionBy("source_id").orderBy(F.desc("composite"), "start_frame", "id", "event_id")
    valid = own.where(F.size("errors") == 0).withColumn("position", F.row_number().over(order))
    columns = ["source_id", "event_id", "id", "start_frame", "end_frame", "topic_key", "composite"]
    # all that is told of a candidate goes through the fold once, and kept and lost ones through the same windows
    judged = suppress(valid.select(*columns, "position"), percent).repartition("source_id").withColumn("lost", F.col("suppressor").isNotNull())
    again = F.row_number().over(W.partitionBy("source_id", "lost", "topic_key").orderBy("position")) > 1
    judged = judged.withColumn("again", again if diverse else F.lit(False)).withColumn("place", F.row_number().over(W.partitionBy("source_id", "lost").orderBy("again", "position")))
    lost, chosen = F.col("lost"), ~F.col("lost") & (F.col("place") <= count)
    reasons = F.when(lost, F.concat(F.lit("overlaps "), F.col("suppressor"))).when(chosen, "ranked by composite and diversity").otherwise("outside requested count")
    judged = judged.select(*columns, F.when(chosen, F.col("place")).alias("rank"), F.when(chosen, "selected").otherwise("rejected").alias("status"), reasons.alias("reasons"))
    wrong = own.where(F.size("errors") > 0).select(*columns, F.lit(None).cast("int").alias("rank"), F.lit("rejected").alias("status"), F.array_join("errors", "; ").alias("reasons"))
    return judged.union(wrong)


def in_order(ranked: DataFrame) -> DataFrame:
    """Ranked candidates by source: the selected by rank, then the rejected by start and id."""
    return ranked.orderBy("source_id", F.col("rank").asc_nulls_last(), F.coalesce("start_frame", F.lit(-1)), "id", "event_id")
