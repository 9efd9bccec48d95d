"""How the sources of each language differ in their words: every pair of sources, and the words that mark a source.

Terms are runs of letters and of characters beyond ASCII, A-Z in lower case. A language keeps the terms that at least
`least` of its documents hold. A group, a source in a language, gives each kept term the share
p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two groups differ in a term by floor((p - q)^2 / (p + q)). All is whole numbers.

The sums over all pairs of groups and all terms are split. Terms in many groups (heavy) fill dense tiles of TILE groups by
terms, and numpy adds up pairs of tiles. Rare terms (light) are never spread out: two groups without a term have the
difference of their bare shares, so each pair starts with that times the number of light terms; a group with a term
corrects its difference to all others, once for each distinct count; and two holders of one term, neighbours in its
posting list, correct the overlap of both. The three sums and the tiles' add up exactly.

A null text, language or source counts as empty. Rows with one doc_id count as documents of their own, as do equal rows.
A group without terms takes part, with all counts 0. Counts are of whole texts, gathered a task before they are shuffled.
An empty table gives no rows; other columns take no part. p is exact up to counts beyond a long; sums of differences of
one pair must fit a long.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm._store import forget, kept, small_batches, small_side

#: A language keeps terms of so many documents.
LEAST = 10
#: Ranks of terms that are reported for a group.
TOP = 10
#: Groups in a tile's side.
TILE = 64
#: A term is heavy if it is in more than the groups' number through this.
HEAVY = 4
#: Terms counted by a task at a time, and rows of terms in a slice of a pair of tiles.
HELD, SLICE_ROWS = 300_000, 250_000
#: Rows, and terms of a tile, that a task holds as arrays.
ROWS, COLUMNS = 20_000, 1024
SMALL_ROWS = 200_000

#: Bytes of terms in lower case, all others a blank.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SLICE = 1 << 22
BILLION = 10**9


def terms_of(text: bytes):
    """Lists of a text's terms, a few megabytes at a time."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > _SLICE:
            cut = text[at : at + _SLICE].translate(_TERM).rfind(b" ")
            end = at + cut + 1 if cut >= 0 else end  # a term longer than a slice: the rest at once
        yield text[at:end].translate(_TERM).split()
        at = end


def _counted(batches):
    """(lang, source, term, n, docs) of what a task has read; a row without a term for each group."""
    held: dict = defaultdict(lambda: (Counter(), Counter()))

    def rows():
        for (lang, source), (n, docs) in held.items():
            size = len(n) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size), pa.array([source] * size), pc.cast(pa.array([None, *n], pa.binary()), options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True)), pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64())],
                names=["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    kept_terms = 0
    for batch in batches:
        lang, source, text = (batch.column(i) for i in range(3))
        for key, data in zip(zip(lang.to_pylist(), source.to_pylist()), text):
            n, docs = held[key]
            kept_terms -= len(n)
            seen: set = set()
            for found in terms_of(data.as_py()):
                n.update(found)
                seen.update(found)
            docs.update(seen)
            kept_terms += len(n)
            if kept_terms > HELD:
                yield from rows()
                kept_terms = 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): how often and in how many documents a group has a term; each group also has a row with a null term."""
    small_batches(docs.sparkSession)
    bare = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = docs.select(bare("lang").alias("lang"), bare("source").alias("source"), bare("text").cast("binary").alias("text"))
    return own.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """The share of a term with n of `total` occurrences among `terms` terms, in billionths."""
    n, total, terms = (F.col(c) if isinstance(c, str) else c for c in (n, total, terms))
    whole = F.lit(BILLION).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.floor(whole / (total + 2 * terms).cast("decimal(20,0)")).cast("long")).otherwise(1)


def _difference(p, q):
    return (p - q) ** 2 // (p + q)


class _Tiles:
    """The sums of one pair of tiles, from one slice of its terms."""

    def __init__(self, i: int, j: int):
        self.i, self.j = i, j
        self.ids: dict[int, np.ndarray] = {}
        self.bare: dict[int, np.ndarray] = {}
        self.sums = None

    def groups(self, gid: np.ndarray, p: np.ndarray, n: np.ndarray) -> None:
        for t in {self.i, self.j}:
            own = gid // TILE == t
            self.ids[t], self.bare[t] = gid[own], p[own]
        a, b = self.bare[self.i], self.bare[self.j]
        self.sums = int(n[0]) * _difference(a[:, None], b[None, :])

    def heavy(self, tid: np.ndarray, gid: np.ndarray, p: np.ndarray) -> None:
        terms, column = np.unique(tid, return_inverse=True)
        for first in range(0, len(terms), COLUMNS):
            width, here = min(COLUMNS, len(terms) - first), (column >= first) & (column < first + COLUMNS)
            dense = {}
            for t in {self.i, self.j}:
                own = here & (gid // TILE == t)
                dense[t] = np.repeat(self.bare[t][:, None], width, axis=1)
                dense[t][gid[own] % TILE, column[own] - first] = p[own]
            a, b = dense[self.i], dense[self.j]
            for g in range(len(a)):
                self.sums[g] += _difference(a[g][None, :], b).sum(axis=1)

    def single(self, gid: np.ndarray, p: np.ndarray, n: np.ndarray) -> None:
        for rows, columns, sums in ((self.i, self.j, self.sums), (self.j, self.i, self.sums.T)):
            own = gid // TILE == rows
            g, q = gid[own] % TILE, self.bare[columns][None, :]
            np.add.at(sums, g, n[own][:, None] * (_difference(p[own][:, None], q) - _difference(self.bare[rows][g][:, None], q)))

    def light(self, tid: np.ndarray, gid: np.ndarray, p: np.ndarray) -> None:
        ends = np.searchsorted(tid, tid, side="right")
        more = ends - np.arange(len(tid)) - 1  # holders of the same term that follow, by gid
        first = np.repeat(np.arange(len(tid)), more)
        second = np.arange(len(first)) - np.repeat(np.cumsum(more) - more, more) + first + 1
        own = (gid[first] // TILE == self.i) & (gid[second] // TILE == self.j)
        first, second = first[own], second[own]
        g, h = gid[first] % TILE, gid[second] % TILE
        a, b = self.bare[self.i][g], self.bare[self.j][h]
        both = _difference(p[first], p[second]) - _difference(p[first], b) - _difference(a, p[second]) + _difference(a, b)
        np.add.at(self.sums, (g, h), both)


def _summed(batches):
    """(lang, g, h, value) of sorted rows (lang, i, j, slice, kind, tid, gid, p, n): kinds are 0 groups, 1 heavy, 2 light terms, 3 their distinct counts."""
    now, kind, tiles, held = None, None, None, []

    def done(final: bool):
        """Adds up what is held; the last term's rows wait for more unless all are there."""
        nonlocal held
        if not held:
            return
        tid, gid, p, n = (np.concatenate([h[k] for h in held]) for k in range(4))
        cut = len(tid) if final or kind in (0, 3) else int(np.searchsorted(tid, tid[-1]))
        held = [] if cut == len(tid) else [(tid[cut:], gid[cut:], p[cut:], n[cut:])]
        if not cut or kind == 0 and not final:
            held = held or [(tid, gid, p, n)]
            return
        tid, gid, p, n = tid[:cut], gid[:cut], p[:cut], n[:cut]
        if kind == 0:
            tiles.groups(gid, p, n)
        elif kind == 1:
            tiles.heavy(tid, gid, p)
        elif kind == 2:
            tiles.light(tid, gid, p)
        else:
            tiles.single(gid, p, n)

    def out():
        g, h = np.meshgrid(tiles.ids[tiles.i], tiles.ids[tiles.j], indexing="ij")
        own = g < h
        return pa.RecordBatch.from_arrays([pa.array([now[0]] * int(own.sum()), pa.string()), pa.array(g[own]), pa.array(h[own]), pa.array(tiles.sums[own])], names=["lang", "g", "h", "value"])

    for batch in batches:
        if not batch.num_rows:
            continue
        lang = np.array(batch.column(0).to_pylist(), dtype=object)
        i, j, part, kinds, *rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns[1:])
        change = np.flatnonzero((lang[1:] != lang[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (part[1:] != part[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for a, z in zip([0, *change], [*change, len(lang)]):
            key = lang[a], int(i[a]), int(j[a]), int(part[a])
            if key != now or kinds[a] != kind:
                done(True)
                if key != now:
                    if now is not None:
                        yield out()
                    now, tiles = key, _Tiles(key[1], key[2])
                kind = int(kinds[a])
            for at in range(a, z, ROWS):
                held.append(tuple(c[at : min(z, at + ROWS)] for c in rest))
                if sum(len(h[0]) for h in held) >= ROWS:
                    done(False)
    done(True)
    if now is not None:
        yield out()


def _tiled(rows: DataFrame, slices: Column) -> DataFrame:
    """Rows (lang, groups, kind, tid, gid, p, n), once for every pair of tiles that their group is in."""
    tile = F.floor(F.col("gid") / TILE)
    other = F.explode(F.sequence(F.lit(0), F.floor((F.col("groups") - 1) / TILE).cast("int"))).alias("other")
    own = rows.select("*", other)
    return own.select("lang", F.least(tile, "other").cast("int").alias("i"), F.greatest(tile, "other").cast("int").alias("j"), slices.cast("int").alias("slice"), "kind", "tid", "gid", "p", "n")


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` has every other source of the language, by difference; part `term` the `top` terms that a source has more of than its language."""
    counts = kept(term_counts(docs))
    of_term = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("df"), F.sum("n").alias("total"), F.count("*").alias("holders"))
    terms = kept(of_term.where(F.col("df") >= least).drop("df").withColumn("tid", F.monotonically_increasing_id()))
    held = kept(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "tid", "n", "total", "holders"))
    vocabulary = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_total"))
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    groups = counts.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(vocabulary, "lang", "left").fillna(0, ["terms", "lang_total", "group_total"])
    gid = (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).cast("long")
    groups = kept(groups.withColumns({"gid": gid, "groups": F.count("*").over(W.partitionBy("lang"))}))
    named = small_side(groups, SMALL_ROWS)
    own = held.join(named, ["lang", "source"]).withColumn("p", share("n", "group_total", "terms"))

    over = F.expr("(p - q) * (p - q) div (p + q)")
    marks = own.withColumn("q", share("total", "lang_total", "terms")).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), over.alias("value"))
    by = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    marks = marks.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)

    n_slices = max(1, -(-held.count() // SLICE_ROWS))
    many = F.col("holders") * HEAVY > F.col("groups")
    of_terms = own.select("lang", "groups", F.when(many, 1).otherwise(2).alias("kind"), "tid", "gid", "p", F.lit(1).cast("long").alias("n"))
    light = own.where(~many)
    # kind 3: a group's light terms by count; their number is once known a language
    n_light = light.select("lang", "tid").distinct().groupBy("lang").agg(F.count("*").alias("n_light"))
    single = light.groupBy("lang", "groups", "gid", "p").agg(F.count("*").alias("n")).select("lang", "groups", F.lit(3).alias("kind"), F.lit(0).cast("long").alias("tid"), "gid", "p", "n")
    bare = groups.join(n_light, "lang", "left").select("lang", "groups", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("tid"), "gid", share(F.lit(0), "group_total", "terms").alias("p"), F.coalesce("n_light", F.lit(0)).alias("n"))
    part = F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))).alias("part")
    bare = _tiled(bare, F.lit(0)).drop("slice").select("*", part).select("lang", "i", "j", F.col("part").alias("slice"), "kind", "tid", "gid", "p", F.when(F.col("part") == 0, F.col("n")).otherwise(0).alias("n"))
    rows = bare.unionByName(_tiled(of_terms, F.pmod(F.hash("tid"), F.lit(n_slices)))).unionByName(_tiled(single, F.lit(0)))
    keys = ["lang", "i", "j", "slice"]
    summed = rows.repartition(*keys).sortWithinPartitions(*keys, "kind", "tid", "gid").mapInArrow(_summed, "lang string, g long, h long, value long")
    pairs = summed.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", F.explode(F.array(F.struct("g", "h"), F.struct(F.col("h").alias("g"), F.col("g").alias("h")))).alias("x"), "value")
    name = lambda side, alias: named.select("lang", F.col("gid").alias(side), F.col("source").alias(alias))
    both = both.select("lang", "x.g", "x.h", "value").join(name("g", "source"), ["lang", "g"]).join(name("h", "item"), ["lang", "h"])
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by))
    out = kept(both.unionByName(marks))
    forget(counts, terms, held, groups)
    return out
