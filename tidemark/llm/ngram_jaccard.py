"""Exact Jaccard join of documents over word shingles, in the metric space of Jaccard distance.

1. Every text becomes its set of hashed word shingles. Documents with equal
   sets form a class; only the class's smallest id goes on.
2. Ground cells. Shingles have one global order (rare before frequent, then by
   hash). Of two linked sets the larger holds a shared shingle among its first
   `n - ceil(t * n) + 1` and the other among its still fewer first ones
   (`index_length`), so each shingle is a cell, and cells with one pivot (the
   document of least hash that holds the shingle as an indexed one) are one region.
3. Members of a region are first held apart by their distances to fixed pivots:
   the classes of a hash partition of all shingles (`sketch`). By the triangle
   inequality these rule out most pairs exactly and cut the regions into small
   chains of documents that may be similar; only their sets are sent, once each.
4. In a chain distances to pivots are computed exactly: what is within reach
   of a pivot is linked to it. What is left is split where distances leave a gap
   wider than the threshold, or between two pivots with the boundary replicated,
   and goes on recursively (`region_links`).
5. A region or chain too large for one task becomes Voronoi regions in Spark
   (`_voronoi_links`): documents are assigned to the nearest of its pivots by
   exact distance, boundary documents are replicated within the windows that the
   triangle inequality gives, and documents far from all pivots form a region of
   their own. Regions are split again, with pivots of their own, while that at least
   halves what is left to compare. What is linked with the pivots already needs no
   comparison with itself: only the others are held against all, block by block.
6. Links (a spanning set of each region's links) are merged by connected
   components.

Texts that are null or have no words are empty: they link with nothing. Each
input row is its own document; rows of one doc_id are told apart by their
text. Rows with a null doc_id take part in no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import _text
from tidemark.llm._store import forget, hot_join, kept, small_batches, small_side, unwrapped, wrapped
from tidemark.llm.components import components

CHUNK = 2_000_000
FREQUENT = 6
#: Shingles whose order depends on their count. Only the order of prefixes depends on it, never a result.
MAX_FREQUENT = 1 << 18
#: Ids up to this number are broadcast (16 MB); beyond it Spark joins by shuffle.
SMALL_ROWS = 1_000_000
#: Sets of a region or chain joined in one task, in bytes and in rows; larger ones become Voronoi regions.
BLOCK_BYTES = 24 << 20
BLOCK_ROWS = 4_000
#: Pivots of a large region, on average: two a block of its rows, between these numbers.
PIVOTS = 8
MAX_PIVOTS = 64
#: The distance from which a document belongs to no pivot.
FAR = 0.6
#: Sets of pivots sent to the tasks at a time.
PIVOT_BYTES = 32 << 20


def _sets(batches, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Row ranges with the sorted shingle set of every row."""
    for batch in batches:
        for first, end, data, offsets in _text.string_slices(batch, "text"):
            _, _, hashes, bounds = _text.words(data, offsets)
            runs, at = _text.shingles(hashes, bounds, size)
            yield batch.slice(first, end - first), [np.unique(runs[at[i] : at[i + 1]]) for i in range(end - first)]


def _fingerprints(batches, size: int):
    """A row (n, f1, f2) for each document, and rows (token, seen) for what is frequent in a chunk of shingles."""
    waiting, held = [], 0

    def frequent():
        tokens, count = np.unique(np.concatenate(waiting), return_counts=True)
        often = count >= FREQUENT
        k = int(often.sum())
        none = pa.nulls(k, pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(tokens[often].view(np.int64)), pa.array(count[often])], names=["doc_id", "n", "f1", "f2", "token", "seen"])

    for rows, sets in _sets(batches, size):
        f1 = np.array([_text.mix(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
        f2 = np.array([_text.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
        n = len(sets)
        none = pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), none, none], names=["doc_id", "n", "f1", "f2", "token", "seen"])
        waiting += sets
        held += sum(map(len, sets))
        if held >= CHUNK:
            yield frequent()
            waiting, held = [], 0
    if waiting:
        yield frequent()


def prefix_length(n: int, percent: int) -> int:
    """How many first shingles must meet those of any set that is similar enough."""
    return n - -(-percent * n // 100) + 1 if n else 0


def index_length(n: int, percent: int) -> int:
    """How many first shingles of a set must meet the prefix of any set at least as large that is similar enough."""
    return n - -(-2 * percent * n // (100 + percent)) + 1 if n else 0


def sketch(words: np.ndarray) -> np.ndarray:
    """How many shingles a set has in each of 64, 128, ... hash classes, about one class for eight shingles.

    The classes are disjoint pivots: by the triangle inequality the differences
    of two sketches add up to no more than the sets' symmetric difference.
    """
    level = min(max(0, (len(words) // 8 - 1).bit_length() - 6), 6)
    return np.bincount((_text.mix(words) >> np.uint64(58 - level)).astype(np.int64), minlength=64 << level).astype(np.uint16)


def sketch_links(sizes: np.ndarray, sketches: list[np.ndarray], percent: int, indexed: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning set of the pairs, of which one is `indexed`, whose sketches leave it open that they are similar enough."""
    m, links = len(sizes), []
    indexed = np.ones(m, bool) if indexed is None else indexed
    level = np.array([len(s) for s in sketches])
    at = {k: np.flatnonzero(level == k) for k in np.unique(level)}
    own = {k: np.stack([sketches[i] for i in v]).astype(np.int32) for k, v in at.items()}
    # a set of the next level is compared in the coarser classes; farther levels differ too much in size
    coarse = {k: x.reshape(len(x), -1, 2).sum(2) for k, x in own.items()}
    root = np.arange(m)
    for i in range(m):
        k = level[i]
        row = sketches[i].astype(np.int32)
        for other, matrix, mine in ((k, own, row), (2 * k, coarse, row), (k // 2, own, row.reshape(-1, 2).sum(1))):
            if other not in at:
                continue
            begin = int(np.searchsorted(at[other], i, side="right"))
            j = at[other][begin:]
            fits = (root[j] != root[i]) & (100 * np.minimum(sizes[j], sizes[i]) >= percent * np.maximum(sizes[j], sizes[i]))
            open_ = np.flatnonzero(fits if indexed[i] else fits & indexed[j])
            if not len(open_):
                continue
            apart = np.abs(matrix[other][begin + open_] - mine).sum(1)
            for x in j[open_[apart * (100 + percent) <= (sizes[j[open_]] + sizes[i]) * (100 - percent)]].tolist():
                if root[x] != root[i]:
                    links.append((i, x))
                    root[root == root[x]] = root[i]
    return links


def _pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _sketch_regions(batches, percent: int):
    for rows in _grouped(batches):
        held = [h for _, h in rows]
        pairs = sketch_links(np.array([h[0] for h in held]), [np.frombuffer(h[1], np.uint16) for h in held], percent, np.array([h[2] for h in held]))
        yield _pairs([rows[i][0] for i, _ in pairs], [rows[j][0] for _, j in pairs])


def _prefixes(batches, size: int, percent: int, frequent):
    known, count = frequent.value
    for rows, sets in _sets(batches, size):
        out = []
        for s in sets:
            k = prefix_length(len(s), percent)
            if len(known) and len(s):
                at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                weight = np.where(known[at] == s, count[at], 0)
                if weight.any():
                    s = s[np.lexsort((s, weight))]
            out.append(s[:k].copy())
        own = pa.array([index_length(len(s), percent) for s in sets], pa.int32())
        yield pa.RecordBatch.from_arrays([rows.column(0), _text.long_array(out), own, pa.array([sketch(s).tobytes() for s in sets], pa.binary())], names=["doc_id", "prefix", "own", "sketch"])


def _set_rows(batches, size: int):
    for rows, sets in _sets(batches, size):
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array([s.tobytes() for s in sets], pa.binary())], names=["x", "region", "words"])


def region_links(sets: list[np.ndarray], percent: int, split: int = 48, label: np.ndarray | None = None, pivots: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning set of the links between sorted sets: pivots, gaps and windows by the triangle inequality, recursion.

    `label` names sets that are known to be linked already; with `pivots` only
    links of those are looked for. Every pivot leaves its cell, and a cell is cut
    in two only where the parts together are little larger than it is, so the work
    grows with the sets outside the largest component times the cell, no faster.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    label = np.arange(m) if label is None else label.copy()
    able = np.ones(m, bool) if pivots is None else pivots
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(size)])
    # postings: the members that hold each word, so that a pivot meets only the sets it shares words with
    member = np.repeat(np.arange(m), size)[np.argsort(flat, kind="stable")]
    posting = np.concatenate([[0], np.cumsum(np.bincount(flat))])
    eps = 1 - percent / 100 + 1e-9
    links: list[tuple[int, int]] = []

    def against(p: int, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of a cell to a pivot; links to it are made."""
        own = flat[starts[p] : starts[p + 1]]
        n = posting[own + 1] - posting[own]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(posting[own], n)
        both = np.bincount(member[at], minlength=m)[cell]
        union = size[cell] + size[p] - both
        near = 100 * both >= percent * union
        for x in cell[near]:
            if label[x] != label[p]:
                links.append((int(p), int(x)))
                label[label == label[x]] = label[p]
        return 1 - both / union, near

    todo = [np.lexsort((np.arange(m), size))[(size == 0).sum() :]]
    while todo:
        cell = todo.pop()
        names, count = np.unique(label[cell], return_counts=True)
        if len(names) < 2:
            continue
        outside = cell[(label[cell] != names[count.argmax()]) & able[cell]]
        if not len(outside):  # pivots of the largest component are still open if others are none
            outside = cell[able[cell]]
            if not len(outside):
                continue
        p = int(outside[0])
        cell = cell[cell != p]
        d, near = against(p, cell)
        if not near.all():
            keep = ~near | (d >= d[~near].min() - eps)
            cell, d = cell[keep], d[keep]
        else:  # all are linked with the pivot
            continue
        order = np.argsort(d, kind="stable")
        ranks = d[order]
        parts = np.split(cell[order], np.flatnonzero(np.diff(ranks) > eps) + 1)
        if len(parts) == 1 and len(cell) > split:
            q = int(cell[order[-1]])
            if able[q]:
                held, d = cell[order[:-1]], ranks[:-1]
                e, _ = against(q, held)
                parts = [held]
                sides = [held[d - e <= 2 * eps], held[d > e]]
                if 20 * sum(map(len, sides)) <= 23 * len(held) and 20 * max(map(len, sides)) <= 17 * len(held):
                    parts = sides
        todo += [np.sort(x) if len(parts) > 1 else x for x in parts]
    return links


def _grouped(batches):
    """The rows (x, third column) of each region, from batches sorted by region; one region at a time."""
    now, group = None, []
    for batch in batches:
        x = batch.column(0).to_pylist()
        words = [tuple(w.values()) for w in batch.column(2).to_pylist()] if pa.types.is_struct(batch.column(2).type) else batch.column(2).to_pylist()
        for i, region in enumerate(batch.column(1).to_pylist()):
            if region != now:
                if group:
                    yield group
                now, group = region, []
            group.append((x[i], words[i]))
    if group:
        yield group


def _join_regions(batches, percent: int):
    for rows in _grouped(batches):
        pairs = region_links([np.frombuffer(w, dtype=np.uint64) for _, w in rows], percent)
        yield _pairs([rows[i][0] for i, _ in pairs], [rows[j][0] for _, j in pairs])


def _join_blocks(batches, percent: int):
    """Links of the members with `side` to all members of a block; the others are one component by region and label."""
    for rows in _grouped(batches):
        held: dict[int, tuple] = {}
        for x, (words, label, side) in rows:
            held[x] = (words, label, side or (x in held and held[x][2]))
        xs = sorted(held, key=lambda x: (len(held[x][0]), x))
        _, label = np.unique([held[x][1] for x in xs], return_inverse=True)
        pairs = region_links([np.frombuffer(held[x][0], dtype=np.uint64) for x in xs], percent, label=label, pivots=np.array([held[x][2] for x in xs]))
        yield _pairs([xs[i] for i, _ in pairs], [xs[j] for _, j in pairs])


def _to_pivots(batches, percent: int, sent):
    """Rows (region, x, cell, pivot) of documents (region, x, words): a row with a pivot is a link to it, one with a cell (-1: far from all) is a place."""
    pivots, eps = sent.value, 1 - percent / 100 + 1e-9
    for batch in batches:
        rows: list[tuple] = []
        for region, x, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
            words, d = np.frombuffer(words, np.uint64), []
            for p, own in pivots.get(region, ()):
                at = np.minimum(np.searchsorted(own, words), len(own) - 1)
                both = int((own[at] == words).sum())
                d.append(1 - both / (len(own) + len(words) - both))
                if 100 * both >= percent * (len(own) + len(words) - both) and p != x:
                    rows.append((region, x, None, p))
            least = min(d, default=1.0)
            if least < FAR:
                a = d.index(least)
                rows += [(region, x, k, None) for k in range(a + 1) if k == a or d[k] <= least + 2 * eps]
            if least >= FAR - eps:
                rows.append((region, x, -1, None))
        columns = zip(*rows) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["region", "x", "cell", "pivot"])


def _placed(sets: DataFrame, members: DataFrame, level: int, percent: int, block_rows: int) -> DataFrame:
    """Rows (region, x, cell, pivot) of members (region, x, u); the pivots of a region, more in a larger one, are drawn from its members with u."""
    spark = sets.sparkSession
    sizes = kept(members.where("u").groupBy("region").agg(F.count("*").alias("of")))
    many = F.greatest(F.lit(PIVOTS), F.least(F.lit(MAX_PIVOTS), F.ceil(2 * F.col("of") / block_rows)))
    drawn = members.where("u").join(small_side(sizes, SMALL_ROWS), "region").where(F.pmod(F.xxhash64("x", "region", F.lit(level)), F.col("of")) < many).select("region", "x")
    pivots = kept(drawn.join(sets, "x").select("region", "x", "words"))
    blocks = max(1, -(-(pivots.agg(F.sum(F.length("words"))).first()[0] or 0) // PIVOT_BYTES))
    placed = None
    for i in range(blocks):
        here = F.pmod(F.xxhash64("region"), F.lit(blocks)) == i
        own: dict[int, list] = {}
        for region, x, words in pivots.where(here).sort("region", "x").collect():  # one block of the pivots
            own.setdefault(region, []).append((x, np.frombuffer(words, np.uint64)))
        sent = spark.sparkContext.broadcast(own)
        at = members.where(here).join(sets, "x").select("region", "x", "words").mapInArrow(lambda it, sent=sent: _to_pivots(it, percent, sent), "region long, x long, cell int, pivot long")
        placed = at if placed is None else placed.union(at)
    placed = kept(placed)
    forget(sizes, pivots)
    return placed


def _marked(rows: DataFrame, named: DataFrame) -> DataFrame:
    """rows (region, of, x) with their label and u: whether that is another than the most frequent one of the region, which needs no comparison with itself."""
    own = kept(rows.join(named, "x", "left").withColumn("label", F.coalesce("label", "x")))
    main = kept(own.groupBy("region", "label").agg(F.count("*").alias("n")).groupBy("region").agg(F.max(F.struct("n", "label"))["label"].alias("main")))
    out = kept(own.join(small_side(main, SMALL_ROWS), "region").select("region", "of", "x", "label", (F.col("label") != F.col("main")).alias("u")))
    forget(own, main)
    return out


def _loads(marked: DataFrame, weights: DataFrame) -> DataFrame:
    """(region, of, bu, bm): the half blocks that the members with u and all members of a region fill; regions without u are left out."""
    sums = marked.join(weights, "x").groupBy("region", "of").agg(F.sum(F.when(F.col("u"), F.col("w"))).alias("bu"), F.sum("w").alias("bm"))
    return kept(sums.where("bu > 0").select("region", "of", F.ceil("bu").cast("int").alias("bu"), F.ceil("bm").cast("int").alias("bm")))


def _voronoi_links(docs: DataFrame, members: DataFrame, size: int, percent: int, block_bytes: int, block_rows: int) -> DataFrame:
    """(a, b): links inside large regions, each given by its members (region, x).

    Windows: of two linked documents with nearest pivots a < b the second is
    within 2 * eps of its own distance to a; one with no pivot nearer than FAR
    meets the other at FAR - eps from it at least. So every pair that may be
    linked lies together in a Voronoi cell, and cells are regions again: while a
    split at least halves the pairs of blocks left to compare, cells that fill more
    than a block go on with pivots of their own. A region that no split helps
    is compared as it is, members with u against all, block by block.
    """
    members = kept(members)
    sets = kept(_with_sets(docs, members.select("x", F.lit(0).cast("long").alias("region")).distinct(), size).select("x", "words"))
    weights = kept(sets.select("x", (F.length("words") / F.lit(float(block_bytes) / 2) + F.lit(2.0 / block_rows)).alias("w")))
    todo, links, ready, level = members.withColumn("u", F.lit(True)), None, None, 0
    while True:
        placed = _placed(sets, todo, level, percent, block_rows)
        own = placed.where("pivot is not null").select(F.col("x").alias("a"), F.col("pivot").alias("b"))
        links = own if links is None else links.union(own)
        named = components(links).select(F.col("node").alias("x"), F.col("component").alias("label"))
        whole = _marked(todo.select("region", F.col("region").alias("of"), "x"), named)
        cells = _marked(placed.where("cell is not null").select(F.xxhash64("region", "cell", F.lit(level)).alias("region"), F.col("region").alias("of"), "x"), named)
        before, after = _loads(whole, weights), _loads(cells, weights)
        pairs = F.col("bu").cast("long") * F.col("bm")
        split = after.groupBy("of").agg(F.sum(pairs).alias("left"))
        split = before.join(split, "of", "left").select("of", (F.coalesce("left", F.lit(0)) * 2 <= pairs).alias("halved"))
        split = kept(split)
        apart, again = kept(after.join(split.where("halved"), "of").select("region", "bu", "bm")), F.col("bu") > 2
        undivided = before.join(split.where("not halved"), "of").select("region", "bu", "bm")
        now = whole.join(small_side(undivided, SMALL_ROWS), "region").union(cells.join(small_side(apart.where(~again), SMALL_ROWS), "region"))
        now = kept(now.select(F.xxhash64("region", F.lit(level)).alias("at"), "x", "label", "u", "bu", "bm"))
        ready = now if ready is None else ready.union(now)
        todo_before, todo = todo, kept(cells.join(small_side(apart.where(again), SMALL_ROWS), "region").select("region", "x", "u"))
        forget(whole, cells, before, after, split, apart, todo_before)
        if todo.isEmpty():
            break
        level += 1
    i, j = F.pmod(F.xxhash64("x", F.lit(1)), F.col("bu")).cast("int"), F.pmod(F.xxhash64("x"), F.col("bm")).cast("int")
    left = ready.where("u").select("at", "x", "label", F.lit(True).alias("side"), i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("bm") - 1)).alias("j"))
    right = ready.select("at", "x", "label", F.lit(False).alias("side"), F.explode(F.sequence(F.lit(0), F.col("bu") - 1)).alias("i"), j.alias("j"))
    pairs = left.union(right).join(sets, "x").select("x", F.xxhash64("at", "i", "j").alias("region"), F.struct("words", "label", "side").alias("held"))
    found = pairs.repartition("region").sortWithinPartitions("region", "x").mapInArrow(lambda it: _join_blocks(it, percent), "a long, b long")
    return links.union(found)


def _with_sets(docs: DataFrame, at: DataFrame, size: int) -> DataFrame:
    """(x, region, words): the documents of `at` (x, region) with their sets, read from their texts."""
    at = at.withColumnRenamed("x", "doc_id")
    return docs.join(small_side(at, SMALL_ROWS), "doc_id").select("doc_id", "text", "region").mapInArrow(lambda it: _set_rows(it, size), "x long, region long, words binary")


def _row_numbers(docs: DataFrame) -> DataFrame | None:
    """(doc_id, h, row, n): a number for each doc_id and text hash h, in the order of both, and how many rows hold them; None where every doc_id is single."""
    own = docs.where("doc_id is not null")
    if own.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return None
    pairs = own.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.count("*").alias("n"))
    return kept(pairs.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").withColumn("row", F.monotonically_increasing_id()))


def _numbered(docs: DataFrame, numbers: DataFrame) -> DataFrame:
    """(doc_id, text) with the number of doc_id and text for a doc_id."""
    own = docs.withColumn("h", F.xxhash64("text")).join(small_side(numbers.drop("n"), SMALL_ROWS), ["doc_id", "h"], "left")
    return kept(own.select(F.col("row").alias("doc_id"), "text"))


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def jaccard_classes(docs: DataFrame, size: int = 5, percent: int = 80, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of `docs` (doc_id, text).

    Two documents link when 100 * |A & B| >= percent * |A | B|; component_id is
    the smallest doc_id reachable by links.
    """
    docs = _read(docs)
    numbers = _row_numbers(docs)
    if numbers is None:
        return _classes(docs, size, percent, block_bytes, block_rows)
    found = _classes(_numbered(docs, numbers), size, percent, block_bytes, block_rows).select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("least"))
    named = numbers.select("row", "doc_id")
    least = numbers.select(F.col("row").alias("least"), F.col("doc_id").alias("component_id"))
    return found.join(named, "row", "left").join(least, "least", "left").select("doc_id", "n_shingles", "component_id")


def _classes(docs: DataFrame, size: int, percent: int, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """jaccard_classes() of rows (doc_id, text) whose doc_id stands for one text."""
    spark = docs.sparkSession
    small_batches(spark)

    first = kept(docs.mapInArrow(lambda it: _fingerprints(it, size), "doc_id long, n long, f1 long, f2 long, token long, seen long"))
    prints = first.where("n is not null").select("doc_id", "n", "f1", "f2")
    classes = kept(prints.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep")))
    often = first.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).orderBy(F.desc("seen"), "token").limit(MAX_FREQUENT).toPandas()
    tokens = often["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    frequent = spark.sparkContext.broadcast((tokens[order], often["seen"].to_numpy(np.int64)[order]))

    reps = small_side(classes.select(F.col("rep").alias("doc_id")).distinct(), SMALL_ROWS)
    prefixes = docs.where("doc_id is not null").mapInArrow(lambda it: _prefixes(it, size, percent, frequent), "doc_id long, prefix array<long>, own int, sketch binary")
    prefixes = kept(prefixes.join(reps, "doc_id", "left_semi"))
    cells = prefixes.select(F.col("doc_id").alias("x"), "own", F.posexplode("prefix").alias("at", "token")).select("x", "token", (F.col("at") < F.col("own")).alias("indexed"))
    pivot = F.min(F.when(F.col("indexed"), F.struct(F.xxhash64("x").alias("h"), "x")))["x"]
    tokens = kept(cells.groupBy("token").agg(pivot.alias("p"), F.count("*").alias("n")).where("n > 1 and p is not null"))
    members = kept(hot_join(cells, tokens, ["token"]).groupBy("p", "x").agg(F.max("indexed").alias("indexed")))
    hot = kept(members.groupBy("p").agg(F.count("*").alias("n")).where(F.col("n") > block_rows).select("p"))

    joined = "a long, b long"
    own = classes.select(F.col("rep").alias("x"), "n")
    drawn = prefixes.select(F.col("doc_id").alias("x"), "sketch").join(own, "x").select("x", "n", "sketch")
    some_hot = not hot.isEmpty()
    cool = members.join(small_side(hot, SMALL_ROWS), "p", "left_anti") if some_hot else members
    at = cool.join(drawn, "x").select("x", F.col("p").alias("region"), F.struct("n", "sketch", "indexed").alias("held")).repartition("region").sortWithinPartitions("region", "x")
    chained = kept(components(at.mapInArrow(lambda it: _sketch_regions(it, percent), joined)).select(F.col("node").alias("x"), F.col("component").alias("r")))
    large = chained.join(own, "x").groupBy("r").agg((8 * F.sum("n")).alias("bytes"), F.count("*").alias("n"))
    large = kept(large.where((F.col("bytes") > block_bytes) | (F.col("n") > block_rows)).select("r"))
    some_large = not large.isEmpty()
    whole = chained.join(small_side(large, SMALL_ROWS), "r", "left_anti") if some_large else chained
    near = _with_sets(docs, whole.select("x", F.col("r").alias("region")), size)
    merged = near.repartition("region").sortWithinPartitions("region", "x").mapInArrow(lambda it: _join_regions(it, percent), joined)
    if some_hot or some_large:
        held = members.join(small_side(hot, SMALL_ROWS), "p", "left_semi").select(F.xxhash64("p").alias("region"), "x")
        held = held.union(chained.join(small_side(large, SMALL_ROWS), "r", "left_semi").select(F.xxhash64("r", F.lit(1)).alias("region"), "x"))
        merged = merged.union(_voronoi_links(docs, held, size, percent, block_bytes, block_rows))
    found = components(merged).select(F.col("node").alias("rep"), F.col("component").alias("least"))
    named = classes.join(found, "rep", "left").select("n", "f1", "f2", F.coalesce("least", "rep").alias("least"))
    out = prints.join(named, ["n", "f1", "f2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that are the first of their component by doc_id and text hash, all columns kept.

    Of rows with equal doc_id and equal text one stays; rows with a null doc_id all stay.
    """
    own = _read(docs)
    numbers = _row_numbers(own)
    if numbers is None:
        gone = _classes(own, size, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
        left = wrapped(docs, "doc_id").join(small_side(gone, SMALL_ROWS), F.col("doc_id") == F.col("__gone"), "left_anti")
        return unwrapped(left, docs.columns, "doc_id")
    later = _classes(_numbered(own, numbers), size, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("row")).distinct()
    marks = numbers.join(later.withColumn("later", F.lit(True)), "row", "left").select(F.col("doc_id").alias("__doc"), F.col("h").alias("__h"), "n", F.coalesce("later", F.lit(False)).alias("__later"))
    marks = kept(marks.where("__later or n > 1").drop("n"))
    key = (F.col("doc_id").cast("long") == F.col("__doc")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__h"))
    both = wrapped(docs, "doc_id", "text").join(small_side(marks, SMALL_ROWS), key, "left").where("__later is null or not __later")
    again = both.where("__doc is not null")
    again = again.groupBy("__doc", "__h").agg(F.first(F.struct("doc_id", "text", "__rest")).alias("row")).select("row.*")
    left = both.where("__doc is null").select("doc_id", "text", "__rest").union(again)
    return unwrapped(left, docs.columns, "doc_id", "text")
