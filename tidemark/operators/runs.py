"""Run manifests: what is missing or stale, what blocks an approval, the state a review has reached, left-over template tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.operators.folds import fold

#: The stages of a run, in order.
STAGES = ("discovered", "analyzed", "ranked", "selected", "materialized", "directed", "handoffs-ready", "built", "rendered", "qc-passed", "delivered")
#: What an action makes of a state; None: of any state.
TRANSITIONS = {
    ("plan", None): "review-pending",
    ("plan-uncertain", None): "uncertain",
    ("fail", None): "failed",
    ("accept", "uncertain"): "review-pending",
    ("approve", "review-pending"): "ready",
    ("publish", "ready"): "published",
}


def run_errors(manifest: DataFrame, contracts: DataFrame, files: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """(run_id, ready, n_clips, errors) of manifests (run_id, clip, contract_id), contracts (contract_id, file_id, sha) and files (file_id, sha).

    `runs` (run_id, sha_planned, sha_now, ranked) adds what is wrong with a run itself; then come its clips' errors in order, all of them.
    """
    held = manifest.join(contracts.withColumn("known", F.lit(True)), "contract_id", "left").join(files.withColumnRenamed("sha", "now"), "file_id", "left")
    error = (
        F.when(F.col("known").isNull(), F.concat(F.lit("missing contract: "), F.col("contract_id").cast("string")))
        .when(F.col("now").isNull(), F.concat(F.lit("missing media: "), F.col("file_id").cast("string")))
        .when(F.col("now") != F.col("sha"), F.concat(F.lit("stale media: "), F.col("file_id").cast("string")))
    )
    own = held.withColumn("error", F.when(error.isNotNull(), F.struct("clip", error.alias("error"))))
    out = own.groupBy("run_id").agg(F.count("*").alias("n_clips"), F.array_sort(F.collect_list("error")).alias("e"))
    errors = F.transform("e", lambda x: x["error"])
    if runs is not None:
        out = runs.join(out, "run_id", "left")
        whole = F.array_compact(F.array(
            F.when(~F.col("sha_now").eqNullSafe(F.col("sha_planned")), "source fingerprint changed"),
            F.when(~F.coalesce("ranked", F.lit(False)), "ranked-shorts.json is missing"),
        ))
        errors = F.concat(whole, F.coalesce(errors, F.array().cast("array<string>")))
    return out.select("run_id", (F.size(errors) == 0).alias("ready"), F.coalesce("n_clips", F.lit(0)).alias("n_clips"), F.array_join(errors, "; ").alias("errors"))


def approvals(manifests: DataFrame) -> DataFrame:
    """(run_id, ready, blockers) of manifests (run_id, errors, n_unresolved, sha_planned, sha_now)."""
    blockers = F.array_compact(F.array(
        F.when(F.size("errors") > 0, F.array_join("errors", "; ")),
        F.when(F.col("n_unresolved") > 0, F.format_string("%d unresolved uncertainty ranges", "n_unresolved")),
        F.when(~F.col("sha_now").eqNullSafe(F.col("sha_planned")), "source file changed since planning"),
    ))
    return manifests.select("run_id", (F.size(blockers) == 0).alias("ready"), F.array_join(blockers, "; ").alias("blockers"))


def review_states(events: DataFrame) -> DataFrame:
    """(run_id, status, n_refused) after a run's events (run_id, seq, action): a fold over its log.

    plan starts a review (with `uncertain` ranges, or not), accept resolves them, approve makes a
    pending review ready, fail ends it until the next plan, publish needs a ready one. What a state does not allow is refused.
    """
    def step(state, action):
        status, refused = state
        to = TRANSITIONS.get((action, None)) or TRANSITIONS.get((action, status))
        state = (to or status, refused + (to is None))
        return state, state

    kind = StructType([StructField("status", StringType()), StructField("refused", LongType())])
    own = fold(events, ["run_id"], ["seq"], ["action"], "state", kind, lambda: ("new", 0), step)
    return own.groupBy("run_id").agg(F.max_by("state", "seq").alias("s")).select("run_id", "s.status", F.col("s.refused").alias("n_refused"))


def leftover_tokens(texts: DataFrame, key: str) -> DataFrame:
    """(key, tokens): template tokens (upper-case names between double underscores) that a text (key, text) still holds, sorted; only texts that hold any."""
    held = F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit("__[A-Z_]+__"), F.lit(0))))
    return texts.select(key, F.array_join(held, ",").alias("tokens")).where("tokens <> ''")


def run_stages(clips: DataFrame) -> DataFrame:
    """(run_id, stage, position, status, n_clips): every stage of the runs of clips (run_id, clip); found and cut ones are complete, the others pending."""
    stage = F.posexplode(F.array(*map(F.lit, STAGES))).alias("position", "stage")
    own = clips.groupBy("run_id").agg(F.count("*").alias("n_clips")).select("run_id", "n_clips", stage)
    done = F.col("stage").isin("discovered", "materialized")
    return own.select("run_id", "stage", "position", F.when(done, "complete").otherwise("pending").alias("status"), F.when(F.col("stage") == "materialized", F.col("n_clips")).alias("n_clips"))


def imported(validated: DataFrame) -> DataFrame:
    """Foreign manifests (passed, errors) as external ones; the status they came with counts for nothing."""
    return validated.withColumn("tier", F.lit("external")).withColumn("status", F.when(F.col("passed"), "review-pending").otherwise("failed"))


def accepted(ranges: DataFrame, reviewer: str, note: str, accept: Column) -> DataFrame:
    """Ranges with who accepted them and why where `accept` holds; the others stay unresolved."""
    return ranges.select("*", F.when(accept, "accepted").otherwise("unresolved").alias("state"), F.when(accept, F.lit(reviewer)).alias("accepted_by"), F.when(accept, F.lit(note)).alias("note"))


def track_counts(shots: DataFrame, sampled: DataFrame, frames: DataFrame, weak: DataFrame) -> DataFrame:
    """(source_id, n_shots, n_sampled, n_frames, n_unresolved) of every source with shots: what the report of a reframing counts.

    A row of `frames` is a frame, or stands for all from `frame` to `last_frame` where there is such a column.
    """
    number = lambda df: F.sum(F.col("last_frame") - F.col("frame") + 1) if "last_frame" in df.columns else F.count("*")
    each = lambda df, kind: df.groupBy("source_id").agg(number(df).alias("n")).select("source_id", F.lit(kind).alias("kind"), "n")
    kinds = {"n_shots": shots, "n_sampled": sampled, "n_frames": frames, "n_unresolved": weak}
    whole = reduce(DataFrame.unionByName, (each(df, kind) for kind, df in kinds.items()))
    count = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(kind)
    return whole.groupBy("source_id").agg(*map(count, kinds)).where("n_shots > 0")


def selection_counts(ranked: DataFrame, count: int) -> DataFrame:
    """(source_id, n_selected, n_requested, n_rejected) of ranked candidates."""
    of = lambda status: F.count_if(F.col("status") == status)
    return ranked.groupBy("source_id").agg(of("selected").alias("n_selected"), F.lit(count).cast("long").alias("n_requested"), of("rejected").alias("n_rejected"))
