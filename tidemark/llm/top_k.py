"""Exact top-k by inner product: norm-sorted candidates, partial sums in a rotated basis, Cauchy-Schwarz bounds.

Components are quantised to floor(scale * x), so scores are whole numbers and exact.

1. The rotation is the eigenvector basis of the vectors' second-moment matrix
   (the right singular vectors of the whole table), whose entries are summed in
   Spark. Most of a product lies in its first dimensions.
2. Candidates are range-partitioned by descending length into ranges of about
   `RANGE_ROWS`. The longest vectors give each query k scores to begin with: a
   floor on its k-th score. Queries are range-partitioned into blocks by floor over
   length, so that a block needs the ranges up to one length and none beyond.
3. A range is sent to one task for each GROUP of blocks, which takes the blocks that need it one after the other, all in one
   job: what is copied are the queries, few against the candidates. There
   candidates are taken by descending length: a query skips a slice, and all that follow,
   when |q| * |x| of the slice's longest can't reach its floor; in a slice it skips
   vectors whose partial product plus the product of the residual lengths can't. What is left is scored exactly.
4. The k best of each query in each range are merged by rank in Spark.

Vectors with a component of over LARGE, whose squares could leave the range of doubles, stay out of all that: as queries
they meet every row, and as candidates every query, in blocks, by whole numbers.

Null vectors, empty ones and those with null or non-finite components take no
part, nor do rows with a null id. A vector of fewer components than another
counts as zero in the others. Each row is a query or candidate of its own, also
where ids repeat: a row meets all rows but itself. Scores beyond a long are given as its ends.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm._store import kept

QUERY_BLOCK = 4096
RANGE_ROWS = 32_768
#: Candidates held against a block of queries at a time.
SLICE = 1024
#: Blocks that a range meets in one task.
GROUP = 16
MOST_TASKS = 20_000
LEADING = 16
SEEDS = 4096
#: Against rounding in the rotated floats; scores are whole numbers.
SLACK = 1e-6
#: Products of lengths below this are sums of exact doubles.
EXACT = float(1 << 53)
_ENDS = -(1 << 63), (1 << 63) - 1
#: Components up to this have lengths, and sums of them over a table, that are finite.
LARGE = 1e140
LARGE_BLOCK = 512


def _matrix(column, size: int) -> np.ndarray:
    """Lists of doubles as rows of `size`, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(n), size))
    out[np.arange(size)[None] < n[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, q, norm2, row): vectors of whole numbers, held as doubles."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    good = F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))
    whole = lambda v: F.when(F.abs(v) < EXACT, F.floor(v).cast("double")).otherwise(v)
    scaled = F.transform("x", lambda v: v * F.lit(float(scale)))
    rows = rows.select("vec_id", "x", scaled.alias("v")).withColumn("large", F.exists("v", lambda v: F.abs(v) > LARGE))
    rows = rows.select("vec_id", F.when(F.col("large"), F.col("x")).otherwise(F.transform("v", whole)).alias("q"), "large")
    return rows.withColumn("norm2", F.when(~F.col("large"), F.aggregate("q", F.lit(0.0), lambda a, v: a + v * v))).withColumn("row", F.monotonically_increasing_id())


def _whole(q: list[float], large: bool, scale: int) -> list[int]:
    """The whole numbers of a row, which holds them scaled unless it is large."""
    return [int(v) * scale if abs(v) >= EXACT else math.floor(v * scale) for v in q] if large else [int(v) for v in q]


def _exact(batches, others, k: int, scale: int, asks: bool):
    """The k best for each query by whole numbers: rows (row, vec_id, q, large) read here meet a block of others, which are the queries if `asks`."""
    best: dict = {}
    for batch in batches:
        for row, vec_id, q, large in zip(*(c.to_pylist() for c in batch.columns)):
            own = _whole(q, large, scale)
            for other, other_id, values in others.value:
                if other != row:
                    score = min(max(sum(a * b for a, b in zip(own, values)), _ENDS[0]), _ENDS[1])
                    (query, query_id), candidate = ((other, other_id), vec_id) if asks else ((row, vec_id), other_id)
                    held = best.setdefault(query, (query_id, []))[1]
                    held.append((-score, candidate))
                    if len(held) > 8 * k:
                        held.sort()
                        del held[k:]
        if not asks:  # a query is read once
            yield _found(best, k)
            best = {}
    if best:
        yield _found(best, k)


def _found(best: dict, k: int) -> pa.RecordBatch:
    rows = [(query, query_id, candidate, -score) for query, (query_id, held) in best.items() for score, candidate in sorted(held)[:k]]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["query_row", "query_id", "vec_id", "score"])


def _by_whole_numbers(rows: DataFrame, is_query, k: int, scale: int) -> DataFrame | None:
    """What queries or candidates that are large add: blocks of them are read at the driver and held against all rows where those lie."""
    spark, schema = rows.sparkSession, "query_row long, query_id long, vec_id long, score long"
    columns = ["row", "vec_id", "q", "large"]
    n, out = rows.where("large").count(), None
    for block in range(-(-n // LARGE_BLOCK)):
        own = rows.where("large").select(*columns, is_query.alias("asked")).where(F.pmod(F.xxhash64("row"), F.lit(-(-n // LARGE_BLOCK))) == block).collect()
        for asks in (True, False):
            held = [(r["row"], r["vec_id"], _whole(r["q"], True, scale)) for r in own if not asks or r["asked"]]
            if not held:
                continue
            sent = spark.sparkContext.broadcast(held)
            met = rows if asks else rows.where(is_query & ~F.col("large"))  # a large query has met all rows
            found = met.select(*columns).mapInArrow(lambda it, sent=sent, asks=asks: _exact(it, sent, k, scale, asks), schema)
            out = found if out is None else out.union(found)
    return out


def _moments(batches, size: int):
    """The entries (at, m) of a task's second-moment matrix."""
    total = np.zeros((size, size))
    for batch in batches:
        x = _matrix(batch.column(0), size)
        total += x.T @ x
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], names=["at", "m"])


def _products(x: np.ndarray, q: np.ndarray) -> list[int] | np.ndarray:
    """Exact inner products of the rows of x with q."""
    if np.sqrt((x**2).sum(1).max() * (q**2).sum()) < EXACT:
        return (x @ q).astype(np.int64)
    own = [int(v) for v in q]
    return np.array([min(max(sum(int(a) * b for a, b in zip(row, own)), _ENDS[0]), _ENDS[1]) for row in x], np.int64)


def _floors(batches, seeds, k: int, size: int):
    """Queries with `floor`, the k-th best of their products with the longest vectors, and its share of their length."""
    rows, x = seeds.value
    for batch in batches:
        own, q = batch.column(1).to_numpy(), _matrix(batch.column(2), size)
        floor = np.full(len(q), -np.inf)
        for at in range(0, len(q), 256):
            part = q[at : at + 256]
            norms = np.sqrt((part**2).sum(1))[:, None] * np.sqrt((x**2).sum(1))[None]
            score = np.minimum(part @ x.T - SLACK * norms, float(_ENDS[1]))  # no more than the score
            score[own[at : at + 256, None] == rows[None]] = -np.inf
            if score.shape[1] >= k:
                floor[at : at + 256] = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        norm = np.sqrt((q**2).sum(1))
        ratio = np.where(norm > 0, floor / np.where(norm > 0, norm, 1), -np.inf)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(floor), pa.array(ratio)], names=["vec_id", "row", "q", "floor", "ratio"])


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(scores) > k:
        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, ~scores))[:k]  # ~s falls as s rises, at both ends too
    return ids[order], scores[order]


class _Range:
    """Candidates (row, vec_id, q) by descending length, with the leading dimensions and the residual lengths of their rotated forms."""

    def __init__(self, left: pa.Table, basis: np.ndarray):
        x = _matrix(left.column("q"), len(basis))
        norms = np.sqrt((x**2).sum(1))
        order = np.argsort(-norms, kind="stable")
        self.basis, self.x, self.norms = basis, x[order], norms[order]
        self.rows, self.ids = left.column("row").to_numpy()[order], left.column("vec_id").to_numpy()[order]
        self.lead, self.rest = np.empty((len(x), min(LEADING, len(basis)))), np.empty(len(x))
        for at in range(0, len(x), SLICE):
            turned = self.x[at : at + SLICE] @ basis
            self.lead[at : at + SLICE], self.rest[at : at + SLICE] = turned[:, :LEADING], np.sqrt((turned[:, LEADING:] ** 2).sum(1))

    def search(self, right: pa.Table, k: int) -> pa.RecordBatch:
        """The k best candidates for each query (row, vec_id, q, floor) of a block."""
        q = _matrix(right.column("q"), len(self.basis))
        own, asked = right.column("row").to_numpy(), right.column("vec_id").to_numpy()
        floor, length = right.column("floor").to_numpy().copy(), np.sqrt((q**2).sum(1))
        turned = q @ self.basis
        lead, rest = turned[:, :LEADING], np.sqrt((turned[:, LEADING:] ** 2).sum(1))
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q)
        for at in range(0, len(self.x), SLICE):
            here = slice(at, at + SLICE)
            norm = self.norms[here]
            live = np.flatnonzero(length * norm[0] * (1 + SLACK) + SLACK >= floor)
            if not len(live):
                break  # every later vector is shorter
            bound = lead[live] @ self.lead[here].T + np.outer(rest[live], self.rest[here])
            bound += SLACK * np.outer(length[live], norm) + SLACK
            for i, reach in zip(live.tolist(), bound):
                near = np.flatnonzero((np.minimum(reach, float(_ENDS[1])) >= floor[i]) & (self.rows[here] != own[i]))
                if not len(near):
                    continue
                score = _products(self.x[at + near], q[i])
                best[i] = _best(np.concatenate([best[i][0], self.ids[at + near]]), np.concatenate([best[i][1], score]), k)
                if len(best[i][1]) == k:
                    floor[i] = max(floor[i], float(best[i][1][-1]) - SLACK * abs(float(best[i][1][-1])))
        n = [len(b[0]) for b in best]
        flat = lambda j: np.concatenate([b[j] for b in best]) if best else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(v) for v in (np.repeat(own, n), np.repeat(asked, n), flat(0), flat(1))], names=["query_row", "query_id", "vec_id", "score"])


def _met(batches, basis: np.ndarray, k: int):
    """Sorted rows (r, g, kind, b, row, vec_id, q, floor): of each r and g first the candidates (kind 0), which are held, then the queries, a block at a time."""
    now, held, candidates, block = None, [], None, []

    def searched():
        nonlocal candidates, held
        if candidates is None:
            candidates, held = _Range(pa.Table.from_batches(held), basis), []
        return candidates.search(pa.Table.from_batches(block), k)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in keys], axis=0)) + 1
        for a, z in zip([0, *change], [*change, batch.num_rows]):
            r, g, kind, b = (int(c[a]) for c in keys)
            if now is not None and now != (r, g, kind, b):
                if block and (held or candidates):
                    yield searched()
                block = []
                if now[:2] != (r, g):
                    candidates, held = None, []
            now = r, g, kind, b
            (block if kind else held).append(batch.slice(a, z - a))
    if block and (held or candidates):
        yield searched()


def _runs(ordered: DataFrame, name: str, stat, rows: int) -> tuple[DataFrame, dict[int, list]]:
    """A range-partitioned table, kept, with `name`: the number of the run of neighbouring partitions, of about `rows` rows, that a row is in; and the stats of each run's partitions."""
    held = kept(ordered.withColumn("part", F.spark_partition_id()))
    ids, stats, before = [], {}, 0
    for part, n, value in sorted(held.groupBy("part").agg(F.count("*").alias("n"), stat.alias("stat")).collect()):  # one row a partition
        ids.append((part, before // rows))
        stats.setdefault(before // rows, []).append(value)
        before += n
    named = held.sparkSession.createDataFrame(ids, f"part int, {name} int")
    return held.join(F.broadcast(named), "part").drop("part"), stats


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, query_block: int = QUERY_BLOCK, range_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of vectors (vec_id, embedding); `is_query` is a condition on vec_id.

    Without `range_rows`, ranges hold RANGE_ROWS candidates, or fewer, 2,048 at least, so that small tables keep all cores busy.
    """
    spark = vectors.sparkSession
    every = kept(quantised(vectors, scale))
    exact = _by_whole_numbers(every, is_query, k, scale)
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    ranked = lambda found: found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
    rows = every.where("not large")
    asked = rows.where(is_query)
    count, size = rows.agg(F.count("*"), F.max(F.size("q"))).first()
    n_queries = asked.count()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long") if exact is None else ranked(exact)
    moments = rows.select("q").mapInArrow(lambda it: _moments(it, size), "at long, m double").groupBy("at").agg(F.sum("m").alias("m")).orderBy("at").toPandas()  # one entry for each pair of dimensions
    values, basis = np.linalg.eigh(moments["m"].to_numpy().reshape(size, size))
    basis = basis[:, np.argsort(-values)]
    longest = rows.orderBy(F.desc("norm2"), "vec_id").limit(SEEDS).select("row", "q").toArrow()
    seeds = spark.sparkContext.broadcast((longest.column("row").to_numpy(), _matrix(longest.column("q"), size)))

    range_rows = range_rows or min(RANGE_ROWS, max(2048, count // spark.sparkContext.defaultParallelism))
    number = max(1, -(-count // range_rows))
    ranges, lengths = _runs(rows.repartitionByRange(number, F.desc("norm2"), "row"), "r", F.max("norm2"), range_rows)
    floors = asked.select("vec_id", "row", "q").mapInArrow(lambda it: _floors(it, seeds, k, size), "vec_id long, row long, q array<double>, floor double, ratio double")
    number = max(1, -(-n_queries // query_block))
    blocks, ratios = _runs(floors.repartitionByRange(number, F.desc("ratio"), "row"), "b", F.min("ratio"), query_block)
    # which ranges a block needs: one number a range and one a block
    needs = lambda ratio: [r for r, norm2 in lengths.items() if max(norm2) ** 0.5 * (1 + SLACK) + SLACK >= ratio or ratio == -np.inf]
    needed = [(b, needs(min(x))) for b, x in ratios.items()]
    tasks = min(MOST_TASKS, 4 * len({(r, b // GROUP) for b, rs in needed for r in rs}))  # the work of a few bytes is large, so they are not to share a task
    cells = kept(spark.createDataFrame(needed, "b int, rs array<int>").select("b", F.explode("rs").alias("r")))
    group = F.floor(F.col("b") / GROUP).cast("int").alias("g")
    left = ranges.join(cells.select("r", group).distinct(), "r").select("r", "g", F.lit(0).alias("kind"), F.lit(-1).alias("b"), "row", "vec_id", "q", F.lit(0.0).alias("floor"))
    right = blocks.join(cells, "b").select("r", group, F.lit(1).alias("kind"), "b", "row", "vec_id", "q", "floor")
    both = left.unionByName(right).repartition(tasks, "r", "g").sortWithinPartitions("r", "g", "kind", "b")
    found = both.mapInArrow(lambda it: _met(it, basis, k), "query_row long, query_id long, vec_id long, score long")
    return ranked(found if exact is None else found.unionByName(exact))
