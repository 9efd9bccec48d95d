"""Tables kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one where it is unset and Spark runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> None:
    """From now on the session's Arrow batches hold at most so many rows and bytes (or one row), so that a task holds few whole texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def kept(df: DataFrame) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read again: it cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidemark/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._kept_at = path
    return out


def forget(*tables: DataFrame | None) -> None:
    """Deletes tables of kept() that nothing reads any more; others are left alone."""
    for df in tables:
        if (path := getattr(df, "_kept_at", None)) is not None:
            jvm = df.sparkSession._jvm
            jvm.org.apache.hadoop.fs.Path(path).getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(jvm.org.apache.hadoop.fs.Path(path), True)


def bounded(df: DataFrame, rows: int) -> bool:
    """Whether df has at most `rows` rows; reads no more than it must to tell."""
    return df.limit(rows + 1).count() <= rows


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most `rows` rows (of a few fixed-width columns), else df as it is."""
    return F.broadcast(df) if bounded(df, rows) else df


def small_lists(df: DataFrame, column: str, values: int) -> DataFrame:
    """df with a broadcast hint if its rows and the values in its lists `column` are at most `values` together, else df as it is."""
    held = df.agg(F.count("*") + F.coalesce(F.sum(F.size(column)), F.lit(0))).first()[0]
    return F.broadcast(df) if held <= values else df


#: Rows from which a key is hot: its rows are joined where they lie instead of being sent to one task.
HOT_ROWS = 1000
#: Hot keys are broadcast up to this number; there are no more than rows / HOT_ROWS of them.
MAX_HOT_KEYS = 1_000_000


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """left joined with `right`, a kept table of one row a key that counts the key's rows of left in `n` (left out of the result).

    Rows of hot keys meet a broadcast of just those keys, the others are shuffled, so that no task gets all rows of a key.
    """
    hot = right.where(F.col(n) > HOT_ROWS)
    held = hot.limit(MAX_HOT_KEYS + 1).count()
    if not held or held > MAX_HOT_KEYS:
        return left.join(right.drop(n), keys)
    near = left.join(F.broadcast(hot.drop(n)), keys)
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(right.where(F.col(n) <= HOT_ROWS).drop(n), keys)
    return near.unionByName(rest)


def wrapped(docs: DataFrame, *own: str) -> DataFrame:
    """The columns `own` and, in one struct __rest, the others, whose names then can't clash with any."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*own, (F.struct(*rest) if rest else F.lit(0)).alias("__rest"))


def scored(docs: DataFrame, kernel, name: str, **own: Column) -> DataFrame:
    """`docs` with a double column `name`, in place of one that they may have.

    `kernel` is a function for mapInArrow from batches of __rest (all columns) and the columns `own` to (__rest, __score).
    """
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__rest"), *(column.alias(c) for c, column in own.items()))
    out = given.mapInArrow(kernel, StructType([given.schema["__rest"], StructField("__score", DoubleType())]))
    return out.select(*(F.col("__rest").getField(c).alias(c) for c in docs.columns if c != name), F.col("__score").alias(name))


def unwrapped(df: DataFrame, columns: list[str], *own: str) -> DataFrame:
    """The `columns` that wrapped() put away, in their order."""
    return df.select(*(F.col(c) if c in own else F.col("__rest").getField(c).alias(c) for c in columns))
