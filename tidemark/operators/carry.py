"""Scans along long keys, spread over many tasks: chunks of a key's order, what each chunk passes on, and the rows again.

A chunk is a stretch of SPAN values of a key's ordinal or frame. Its summary is one row, so the window that carries
summaries along a key is as many times shorter than the key; the rows themselves meet only their own chunk's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Ordinals or frames in a chunk.
SPAN = 1 << 15


def chunk_of(order: str, span: int | None = None) -> Column:
    return F.floor(F.col(order) / (span or SPAN)).cast("long")


def chunked(df: DataFrame, keys: list[str], order: str, span: int | None = None) -> DataFrame:
    """df with `__key`, a struct of its keys, of which nulls are equal too, and `__chunk`."""
    return df.withColumns({"__key": F.struct(*keys), "__chunk": chunk_of(order, span)})


def joined(rows: DataFrame, summaries: DataFrame) -> DataFrame:
    """Rows of chunked() with the columns of their chunk's summary (__key, __chunk, ...); rows that a window has dealt by these are not dealt again."""
    return rows.join(summaries, ["__key", "__chunk"], "left").drop("__key", "__chunk")


def running_max(df: DataFrame, keys: list[str], order: str, value: Column, out: str, span: int | None = None) -> DataFrame:
    """df with `out`, the largest `value` of a key's rows up to this one, and `out`_before, that of the rows before it (null in the first). `order` has no ties."""
    own = chunked(df, keys, order, span).withColumn("__value", value)
    earlier = W.partitionBy("__key").orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = own.groupBy("__key", "__chunk").agg(F.max("__value").alias("__most"))
    chunks = chunks.withColumn("__carried", F.max("__most").over(earlier)).drop("__most")
    local = W.partitionBy("__key", "__chunk").orderBy(order)
    own = own.withColumns({"__upto": F.max("__value").over(local.rowsBetween(W.unboundedPreceding, 0)), "__before": F.max("__value").over(local.rowsBetween(W.unboundedPreceding, -1))})
    own = joined(own, chunks).withColumns({out: F.greatest("__upto", "__carried"), f"{out}_before": F.greatest("__before", "__carried")})
    return own.drop("__value", "__upto", "__before", "__carried")


def before(df: DataFrame, keys: list[str], order: str, values: dict[str, Column], span: int | None = None) -> DataFrame:
    """df with a column for each of `values`: what it is in the key's row before; null in the first. `order` has no ties."""
    own = chunked(df, keys, order, span)
    last = own.groupBy("__key", "__chunk").agg(F.max(F.struct(order, *(v.alias(c) for c, v in values.items()))).alias("__last"))
    last = last.withColumn("__last", F.lag("__last").over(W.partitionBy("__key").orderBy("__chunk")))
    local = W.partitionBy("__key", "__chunk").orderBy(order)
    marked = own.withColumns({"__first": F.row_number().over(local) == 1, **{f"__{c}": F.lag(v).over(local) for c, v in values.items()}})
    out = joined(marked, last)
    return out.withColumns({c: F.when(F.col("__first"), F.col("__last").getField(c)).otherwise(F.col(f"__{c}")) for c in values}).drop("__first", "__last", *(f"__{c}" for c in values))


def _along(ends: DataFrame) -> DataFrame:
    """(__key, __chunk, __prev, __next, final) of chunks' first and last anchors (__a, __z): the last anchor of the chunks before, the first of those behind, and the key's last."""
    along = W.partitionBy("__key").orderBy("__chunk")
    held = lambda column: column.getField("__anchor")
    return ends.select(
        "__key", "__chunk", held(F.last("__z", True).over(along.rowsBetween(W.unboundedPreceding, -1))).alias("__prev"),
        held(F.first("__a", True).over(along.rowsBetween(1, W.unboundedFollowing))).alias("__next"), held(F.last("__z", True).over(along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("final"),
    )


def _beside(own: DataFrame, order: list[str], anchor: str) -> DataFrame:
    """Rows of chunked() with `prev` and `next` as far as their own chunk has them."""
    local = W.partitionBy("__key", "__chunk").orderBy(*order)
    return own.withColumns({"prev": F.last(anchor, True).over(local.rowsBetween(W.unboundedPreceding, -1)), "next": F.first(anchor, True).over(local.rowsBetween(0, W.unboundedFollowing))})


def neighbours(df: DataFrame, keys: list[str], order: list[str], anchor: str, span: int | None = None) -> DataFrame:
    """df with `prev`, the last `anchor` that is not null in the key's rows before, `next`, the first from this row on, and `final`, the key's last."""
    own = chunked(df, keys, order[0], span)
    placed = F.when(F.col(anchor).isNotNull(), F.struct(*order, F.col(anchor).alias("__anchor")))
    ends = _along(own.groupBy("__key", "__chunk").agg(F.min(placed).alias("__a"), F.max(placed).alias("__z")))
    return joined(_beside(own, order, anchor), ends).withColumns({"prev": F.coalesce("prev", "__prev"), "next": F.coalesce("next", "__next")}).drop("__prev", "__next")


def stretches(anchors: DataFrame, ranges: DataFrame, keys: list[str], order: str, anchor: str, span: int | None = None) -> DataFrame:
    """(*keys, first, last, prev, next, final): ranges (*keys, first, last) of `order`, cut behind each of the key's anchors and at chunks.

    All values of a stretch have the same `prev`, the last anchor before them, and `next`, the first that is not before them; `final` is the
    key's last. There are as many as anchors and chunks of ranges: what is between anchors is made of its stretch, without being dealt or sorted.
    """
    wide = span or SPAN
    few = chunked(anchors, keys, order, span).select("__key", "__chunk", F.col(order).cast("long").alias("__at"), anchor)
    chunk = F.explode(F.sequence(chunk_of("first", span), chunk_of("last", span))).alias("__chunk")
    pieces = ranges.where("first <= last").select(F.struct(*keys).alias("__key"), chunk, "first", "last")
    pieces = pieces.select("__key", "__chunk", F.greatest("first", F.col("__chunk") * wide).alias("__low"), F.least("last", F.col("__chunk") * wide + (wide - 1)).alias("__high"))
    # a mark behind all anchors of a chunk stands for what follows the last of them
    marks = pieces.select("__key", "__chunk").distinct().select("*", (F.col("__chunk") * wide + (wide - 1)).alias("__at"), F.lit(None).cast(few.schema[anchor].dataType).alias(anchor))
    rows = few.withColumn("__mark", F.lit(0)).unionByName(marks.withColumn("__mark", F.lit(1)))
    placed = F.when(F.col("__mark") == 0, F.struct("__at", F.col(anchor).alias("__anchor")))
    ends = _along(rows.groupBy("__key", "__chunk").agg(F.min(placed).alias("__a"), F.max(placed).alias("__z")))
    since = F.lag("__at").over(W.partitionBy("__key", "__chunk").orderBy("__at", "__mark"))
    own = _beside(rows.withColumn("__since", since), ["__at", "__mark"], anchor).join(ends, ["__key", "__chunk"]).join(pieces, ["__key", "__chunk"])
    first, last = F.greatest("__low", F.col("__since") + 1), F.least("__high", "__at")
    return own.where(first <= last).select(*(F.col("__key").getField(k).alias(k) for k in keys), first.alias("first"), last.alias("last"), F.coalesce("prev", "__prev").alias("prev"), F.coalesce("next", "__next").alias("next"), "final")


def runs(df: DataFrame, keys: list[str], order: str, holds: str, span: int | None = None, until: str | None = None) -> DataFrame:
    """(*keys, start, end) of runs of rows where the boolean column `holds`: from a run's first `order` to that of the row behind it, or one behind its last where none follows.

    Runs inside a chunk are whole; those at its edges, two a chunk at most, are joined along the key. Both take one way
    through the data. `order` has no ties. A row may stand for all values from its `order` to its `until`; no other row lies between.
    """
    own = df.select(*keys, order, holds, *([until] if until else [])).withColumn("__chunk", chunk_of(order, span))
    local = W.partitionBy(*keys, "__chunk").orderBy(order)
    change = F.when(F.col(holds) != F.coalesce(F.lag(holds).over(local), ~F.col(holds)), 1).otherwise(0)
    marked = own.withColumns({"__following": F.lead(order).over(local), "__i": F.row_number().over(local), "__change": change}).withColumn("__run", F.sum("__change").over(local))
    pieces = marked.groupBy(*keys, "__chunk", "__run").agg(F.min(order).alias("start"), F.max(until or order).alias("__final"), F.max("__following").alias("__next"), (F.min("__i") == 1).alias("__head"), F.max(F.col("__following").isNull()).alias("__tail"), F.first(holds).alias("__holds"))
    # pieces at edges meet along the key; a chunk's last piece is followed by the first of the next chunk
    edge = F.col("__head") | F.col("__tail")
    pieces = pieces.withColumn("__part", F.when(~edge, F.col("__chunk")))
    by = W.partitionBy(*keys, "__part").orderBy("start")
    pieces = pieces.withColumns({"__beyond": F.when(edge, F.lead("start").over(by)), "__before": F.when(F.col("__head") & F.lag("__tail").over(by), F.lag("__holds").over(by))})
    fresh = F.when(edge & F.coalesce(F.col("__before") == F.col("__holds"), F.lit(False)), 0).otherwise(1)
    pieces = pieces.withColumn("__new", fresh).withColumn("__run", F.sum("__new").over(by))
    end = F.coalesce(F.when(F.col("__tail"), F.col("__beyond")).otherwise(F.col("__next")), F.col("__final") + 1)
    return pieces.where("__holds").withColumn("end", end).groupBy(*keys, "__part", "__run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__part", "__run")
