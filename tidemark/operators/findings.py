"""Checks become findings, findings a verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def findings(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, check, status): one row per check of each document."""
    own = docs.join(labels, "doc_id", "left")
    checks = F.array(
        F.struct(F.lit("length").alias("check"), F.when(F.col("n_chars") < 100, "fail").when(F.col("n_chars") < 400, "warn").otherwise("pass").alias("status")),
        F.struct(F.lit("language").alias("check"), F.when(F.col("lang").isin("en", "de", "fr"), "pass").otherwise("warn").alias("status")),
        F.struct(F.lit("quality").alias("check"), F.when(F.col("quality").isNull(), "warn").when(F.col("quality") == 1, "pass").otherwise("fail").alias("status")),
        F.struct(F.lit("toxicity").alias("check"), F.when(F.col("toxic") == 1, "fail").otherwise("pass").alias("status")),
    )
    return own.select("doc_id", F.explode(checks).alias("c")).select("doc_id", "c.check", "c.status")


def report(rows: DataFrame, key: str) -> DataFrame:
    """Counts by status and the verdict: any fail fails, else any warning warns."""
    count = lambda s: F.count_if(F.col("status") == s)
    own = rows.groupBy(key).agg(count("fail").alias("n_fail"), count("warn").alias("n_warn"), F.count("*").alias("n"))
    verdict = F.when(F.col("n_fail") > 0, "fail").when(F.col("n_warn") > 0, "warn").otherwise("pass")
    return own.select(key, verdict.alias("verdict"), "n_fail", "n_warn", (F.col("n") - F.col("n_fail") - F.col("n_warn")).alias("n_pass"))
