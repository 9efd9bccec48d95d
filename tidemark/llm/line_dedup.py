"""Line dedup: repeated runs of lines, found by a suffix array over line ids.

Built by distributed prefix doubling, DataFrame operations only:

1. A text is its sequence of lines (split at newlines). A line's id is a
   96-bit hash of its text with white space trimmed at both ends; blank lines take no part. Lines that occur once cannot be in a repeated run; they
   cut the sequences into segments.
2. Suffixes are ranked by their first line, then by their first 2, 4, 8, ...
   lines: the pair (rank of the first half, rank of the half behind it) is
   ranked by a range-partitioned sort of the distinct pairs. Suffixes whose
   pair is unique, or that end inside it, are settled and drop out; doubling
   goes on until all are.
3. Suffixes of one rank are an interval of the suffix array. A later copy of
   a maximal repeated run goes if the run has `min_lines` lines,
   or is a single line of `long_words` words; the run's first occurrence by
   (doc_id, text hash, line) stays. Later copies of all longer runs are covered by
   those of their stretches of `min_lines` lines, so the intervals of that
   depth name the lines that go.
4. How far a later suffix agrees with the first of its interval, their longest
   common prefix, is found by binary descent over the levels (`common_prefixes`):
   the length in lines of the maximal run that starts there.

Null texts have no lines and stay null. Rows with a null doc_id stay as they
are. Rows with equal doc_id and text are one row to the search: what is deleted
from one is deleted from all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm._store import forget, hot_join, kept, small_lists, unwrapped, wrapped

#: Documents and line numbers up to this number are broadcast (about 64 MB); beyond it Spark joins by shuffle.
SMALL_VALUES = 8_000_000
#: Words from which a line is a passage of its own.
LONG_WORDS = 50
_BLANK = "\t\x0b\x0c\r "


def _has_words(line: Column, least: int) -> Column:
    short = F.length(line) < 2 * least - 1  # so many words have that many characters at least
    return F.when(short, False).otherwise(F.size(F.split(line, f"[{_BLANK}]+")) >= least)


def lines(docs: DataFrame, min_lines: int = 2, long_words: int | None = None) -> DataFrame:
    """(d, seq, pos, until, long, id1, id2): every line that is not blank of documents (doc_id, text).

    d is a struct of doc_id and a text hash, seq counts the lines from 0, pos is
    the line's place, until that of the last of `min_lines` lines (null where there are fewer), long marks lines of `long_words`.
    """
    own = docs.where("doc_id is not null and text is not null").select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h")).alias("d"), F.split("text", "\n").alias("raw"))
    bare = F.transform("raw", lambda x, i: F.struct(i.alias("pos"), F.trim(x, F.lit(_BLANK)).alias("line")))
    own = own.select("d", F.filter(bare, lambda x: x["line"] != "").alias("held"))
    long = (lambda line: F.lit(False)) if long_words is None else (lambda line: _has_words(line, long_words))
    row = lambda x, i: F.struct(x["pos"].alias("pos"), F.get("held", i + min_lines - 1)["pos"].alias("until"), long(x["line"]).alias("long"), F.xxhash64(x["line"]).alias("id1"), F.hash(x["line"]).alias("id2"))
    own = own.select("d", F.posexplode(F.transform("held", row)).alias("seq", "at")).select("d", "seq", "at.*")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    return own if repeated.isEmpty() else own.distinct()


def _ranked(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, rank, n) of the distinct keys held by more than one row; rank follows the order of the keys."""
    classes = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return kept(classes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("rank", F.monotonically_increasing_id()))


def suffix_levels(docs: DataFrame, min_lines: int = 2, long_words: int | None = None) -> list[DataFrame]:
    """For spans of 1, 2, 4, ... lines the suffixes (d, seq, pos, until, long, last, rank) whose first lines of that span occur elsewhere too; last ends their segment."""
    every = kept(lines(docs, min_lines, long_words))
    held = hot_join(every, _ranked(every, "id1", "id2"), ["id1", "id2"])
    segment = F.col("seq") - F.row_number().over(W.partitionBy("d").orderBy("seq"))
    held = held.withColumn("segment", segment).withColumn("last", F.max("seq").over(W.partitionBy("d", "segment")))
    levels, span = [kept(held.select("d", "seq", "pos", "until", "long", "last", "rank"))], 1
    forget(every)
    while not levels[-1].isEmpty():
        now = levels[-1]
        behind = now.select("d", (F.col("seq") - span).alias("seq"), F.col("rank").alias("r2"))
        pairs = now.where(F.col("seq") + 2 * span - 1 <= F.col("last")).withColumnRenamed("rank", "r1").join(behind, ["d", "seq"])
        levels.append(kept(hot_join(pairs, _ranked(pairs, "r1", "r2"), ["r1", "r2"]).select(now.columns)))
        span *= 2
    return levels[:-1] if levels[-1].isEmpty() else levels


def _later(level: DataFrame, kind: int) -> DataFrame:
    """(kind, d, seq, pos, until, fd, fseq): the suffixes of a level that are not the first of their interval, which is at fd, fseq."""
    firsts = kept(level.groupBy("rank").agg(F.min(F.struct("d", "seq")).alias("first"), F.count("*").alias("n")))
    own = hot_join(level, firsts, ["rank"]).where(F.struct("d", "seq") != F.col("first"))
    return own.select(F.lit(kind).alias("kind"), "d", "seq", "pos", "until", F.col("first.d").alias("fd"), F.col("first.seq").alias("fseq"))


def common_prefixes(pairs: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """pairs (kind, d, seq, fd, fseq and more) of suffixes with `n_common`, the number of lines of their longest common prefix.

    Binary descent: if both go on with runs of 2**j lines of one rank, they agree on those and are compared behind them.
    """
    now = kept(pairs.withColumn("n_common", F.lit(0)))
    for j in range(len(levels) - 1, -1, -1):
        level = levels[j].select("d", F.col("seq").alias("at"), "rank")
        wanted = now.groupBy("fd", "fseq", "n_common").agg(F.count("*").alias("n")).withColumn("at", F.col("fseq") + F.col("n_common"))
        wanted = kept(wanted.join(level.select(F.col("d").alias("fd"), "at", F.col("rank").alias("wanted")), ["fd", "at"]).select("fd", "fseq", "n_common", "wanted", "n"))
        both = hot_join(now.withColumn("at", F.col("seq") + F.col("n_common")), wanted, ["fd", "fseq", "n_common"]).join(level, ["d", "at"]).where("rank = wanted")
        grown = both.select("kind", "d", "seq", F.lit(1 << j).alias("more"))
        before, now = now, kept(now.join(grown, ["kind", "d", "seq"], "left").withColumn("n_common", F.col("n_common") + F.coalesce("more", F.lit(0))).drop("more"))
        forget(before, wanted)
    return now


def _of_depth(levels: list[DataFrame], n: int) -> DataFrame | None:
    """Suffixes ranked by their first n lines: two runs of the level below that overlap."""
    k = n.bit_length() - 1
    if k >= len(levels):
        return None
    level, step = levels[k], n - (1 << k)
    if not step:
        return level
    behind = level.select("d", (F.col("seq") - step).alias("seq"), F.col("rank").alias("r2"))
    pairs = level.where(F.col("seq") + n - 1 <= F.col("last")).withColumnRenamed("rank", "r1").join(behind, ["d", "seq"])
    return kept(hot_join(pairs, _ranked(pairs, "r1", "r2"), ["r1", "r2"]).select(level.columns))


def repeated_runs(docs: DataFrame, min_lines: int = 2, long_words: int | None = None) -> DataFrame:
    """(d, pos, until, n_common): line numbers between which a later copy lies of a run of `min_lines` lines, or of a single line of `long_words` words.

    n_common, the longest common prefix, is the number of lines of the longest run that starts there and at the first occurrence too.
    It decides: a suffix names lines if it shares `min_lines` lines with the first of its interval, or a long one.
    """
    levels = suffix_levels(docs, min_lines, long_words)
    later, deep = None, _of_depth(levels, min_lines)
    if deep is not None:
        later = _later(deep, 0)
    if levels and long_words is not None and min_lines > 1:
        single = _later(levels[0].where("long").withColumn("until", F.col("pos")), 1)
        later = single if later is None else later.union(single)
    if later is None:
        return docs.sparkSession.createDataFrame([], "d struct<doc_id:bigint,h:bigint>, pos int, until int, n_common int")
    out = common_prefixes(later, levels).where(F.when(F.col("kind") == 0, F.col("n_common") >= min_lines).otherwise(F.col("n_common") >= 1))
    forget(*levels)
    return out.select("d", "pos", "until", "n_common")


def deleted_lines(docs: DataFrame, min_lines: int = 2, long_words: int | None = None) -> DataFrame:
    """(doc_id, h, lines, longest): for each document that loses any, the numbers of the lines to delete, and its largest n_common."""
    later = kept(repeated_runs(docs, min_lines, long_words))
    covered = later.select("d", F.explode(F.sequence("pos", "until")).alias("line")).groupBy("d").agg(F.collect_set("line").alias("lines"))
    most = later.groupBy("d").agg(F.max("n_common").alias("longest"))
    return covered.join(most, "d").select("d.doc_id", "d.h", "lines", "longest")


def line_report(docs: DataFrame, min_lines: int = 2, long_words: int | None = None) -> DataFrame:
    """`docs` with __lines (null: nothing to delete) and __longest, and the later copies of repeated runs deleted from `text`.

    Blank lines inside a deleted run go with it. Columns of these two names in `docs` give way to them; others may have any name.
    """
    columns = [c for c in docs.columns if c not in ("__lines", "__longest")]
    own = wrapped(docs.select(*(F.col(f"`{c}`") for c in columns)), "doc_id", "text")
    gone = kept(deleted_lines(own, min_lines, long_words).select(F.col("doc_id").alias("__doc"), F.col("h").alias("__h"), F.col("lines").alias("__lines"), F.col("longest").alias("__longest")))
    key = (own["doc_id"] == F.col("__doc")) & (F.xxhash64(own["text"]) == F.col("__h"))
    both = own.join(small_lists(gone, "__lines", SMALL_VALUES), key, "left").drop("__doc", "__h")
    split = both.withColumn("__parts", F.when(F.col("__lines").isNotNull(), F.split("text", "\n")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__parts") - 1), "__lines")
    left = F.array_join(F.transform(stay, lambda i: F.get("__parts", i)), "\n")
    out = split.withColumn("text", F.when(F.col("__lines").isNull(), F.col("text")).otherwise(left))
    return out.select(*(F.col(c) if c in ("doc_id", "text") else F.col("__rest").getField(c).alias(c) for c in columns), "__lines", "__longest")


def without_repeated_lines(docs: DataFrame, min_lines: int = 2, long_words: int | None = LONG_WORDS) -> DataFrame:
    """`docs`, all columns kept, without the later copies of repeated line runs and of long single lines.

    A document of which only white space is left has its text in earlier ones and goes; one that had no text before stays.
    """
    out = line_report(wrapped(docs, "doc_id", "text"), min_lines, long_words)
    return unwrapped(out.where(F.col("__lines").isNull() | (F.trim(F.col("text"), F.lit("\t\n\x0b\x0c\r ")) != "")), docs.columns, "doc_id", "text")
