from __future__ import annotations

import random
import time

import brute
import numpy as np
import pytest
from compare import same_as_sql, tidy
from pyspark.sql import functions as F

from tidemark.llm import _text, ngram_jaccard, queries
from tidemark.llm.components import components

SCHEMA = "doc_id long, text string"


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_equals_brute_force(spark, near_copies):
    got = result(ngram_jaccard.jaccard_classes(spark.createDataFrame(near_copies, SCHEMA)))
    want = sorted(brute.jaccard(near_copies), key=repr)
    # two rows of doc_id 906 have equal texts; the null id takes part in no link
    assert got == want
    assert len({c for d, _, c in want if d is not None and 500 <= d < 508}) == 1


@pytest.mark.parametrize("limits", [{"block_bytes": 4_000}, {"block_rows": 3}, {"block_bytes": 1_500, "block_rows": 5}])
def test_large_regions_give_the_same(spark, near_copies, limits):
    got = result(ngram_jaccard.jaccard_classes(spark.createDataFrame(near_copies, SCHEMA), **limits))
    assert got == sorted(brute.jaccard(near_copies), key=repr)


def spied(monkeypatch):
    """The levels of Voronoi regions that are made from now on."""
    levels, placed = [], ngram_jaccard._placed
    monkeypatch.setattr(ngram_jaccard, "_placed", lambda sets, members, level, *rest: levels.append(level) or placed(sets, members, level, *rest))
    return levels


def test_voronoi_regions_recur(spark, monkeypatch):
    """Families of families, all of one region: a split by pivots halves it again and again."""
    r = random.Random(11)
    rows = []
    for family in range(6):
        core = brute.prose(r, 120)
        for group in range(5):
            base = core[: 112 + family] + ["g%d_%d_%d" % (family, group, i) for i in range(40)]
            for copy in range(6):
                at = r.randrange(len(base))
                rows.append((len(rows), " ".join([*base[:at], "c%d" % len(rows), *base[at + 1 :]])))
    docs, levels = spark.createDataFrame(rows, SCHEMA), spied(monkeypatch)
    members = docs.select(F.lit(1).cast("long").alias("region"), F.col("doc_id").alias("x"))
    links = ngram_jaccard._voronoi_links(docs, members, 5, 80, ngram_jaccard.BLOCK_BYTES, 12).distinct().collect()
    sets, forest = [brute.shingles(t) for _, t in rows], brute.Union(len(rows))
    for a, b in links:
        both = len(sets[a] & sets[b])
        assert 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)
        forest.join(a, b)
    least: dict[int, int] = {}
    for x in range(len(rows)):
        least.setdefault(forest.root(x), x)
    assert [least[forest.root(x)] for x in range(len(rows))] == [c for _, _, c in brute.jaccard(rows)]
    assert max(levels) >= 1


def test_long_chain_at_default_limits(spark, monkeypatch):
    """A chain of more documents than one task joins, with one break in it."""
    n = ngram_jaccard.BLOCK_ROWS + 300
    rows = [(i, " ".join("w%d" % w for w in range(i, i + 40))) for i in range(n) if not 100 <= i < 110]
    levels = spied(monkeypatch)
    got = dict((d, c) for d, _, c in ngram_jaccard.jaccard_classes(spark.createDataFrame(rows, SCHEMA)).collect())
    assert levels and got == {d: 0 if d < 100 else 110 for d, _ in rows}


def test_query_equals_sql(spark):
    assert same_as_sql(spark, queries.QUERIES["op6_ngram_jaccard_join"], queries.SQL["op6_ngram_jaccard_join"]) == 200


def test_empty_table_and_extra_columns(spark, near_copies):
    assert ngram_jaccard.jaccard_classes(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(d, t, "a", 1) for d, t in near_copies if d is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string, n long")
    left = ngram_jaccard.one_of_each(df)
    assert left.columns == df.columns
    want = {c for _, _, c in brute.jaccard([r[:2] for r in rows])}
    assert {r["doc_id"] for r in left.collect()} == want


def test_repeated_rows_and_reused_ids(spark):
    r = random.Random(6)
    a, b, c = (brute.prose(r, 90) for _ in range(3))
    near = lambda text, k: " ".join([*text[:-1], "end%d" % k])
    rows = [(1, near(a, 1)), (5, near(a, 2)), (5, near(b, 1)), (7, near(b, 2)), (8, near(c, 1)), (8, near(c, 1)), (3, near(c, 2)), (9, near(c, 3)), (9, "alone it is"), (9, "alone it is"), (2, "twice"), (2, "twice"), (4, None), (4, None), (None, near(a, 1)), (None, near(a, 1))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(ngram_jaccard.jaccard_classes(df)) == sorted(brute.jaccard(rows), key=repr)
    got = sorted(map(tuple, ngram_jaccard.one_of_each(df).collect()), key=repr)
    # 5 holds two texts: the one is a later copy of 1's, the other is the first of its group
    assert got == sorted([(1, near(a, 1)), (5, near(b, 1)), (3, near(c, 2)), (9, "alone it is"), (2, "twice"), (4, None), *rows[-2:]], key=repr)


def test_all_null(spark):
    df = spark.createDataFrame([(None, None), (None, "a b c d e f"), (1, None)], SCHEMA)
    assert tidy(ngram_jaccard.jaccard_classes(df).toPandas()) == [(1.0, 1.0, 0.0), (None, None, 0.0), (None, None, 2.0)]


def test_region_links_span_all_links():
    r = np.random.default_rng(3)
    for _ in range(20):
        base = r.integers(0, 1 << 60, 80).astype(np.uint64)
        sets = [np.unique(np.where(r.random(80) < 0.06, r.integers(0, 1 << 60, 80).astype(np.uint64), base)) for _ in range(r.integers(2, 130))]
        forest = brute.Union(len(sets))
        for i, j in ngram_jaccard.region_links(sets, 80, split=8):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)
            forest.join(i, j)
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    assert forest.root(i) == forest.root(j)


def test_groups_that_are_alike_but_not_linked():
    r = np.random.default_rng(5)
    draw = lambda n: r.integers(0, 1 << 60, n).astype(np.uint64)
    core, sets = draw(100), []
    for _ in range(40):  # about 0.63 from group to group
        base = np.concatenate([core, draw(29)])
        sets += [np.unique(np.concatenate([base[1 + k :], draw(1)])) for k in range(10)]
    began = time.time()
    links = ngram_jaccard.region_links(sets, 80)
    assert time.time() - began < 3
    forest = brute.Union(len(sets))
    for i, j in links:
        assert i // 10 == j // 10 and forest.join(i, j)
    assert len({forest.root(i) for i in range(len(sets))}) == 40


def test_sketches_rule_out_no_link():
    r = np.random.default_rng(4)
    for n in (6, 60, 700, 5000):
        base = r.integers(0, 1 << 60, n).astype(np.uint64)
        sets = [np.unique(np.where(r.random(n) < 0.1 * r.random(), r.integers(0, 1 << 60, n).astype(np.uint64), base)[: n - r.integers(0, n // 6 + 1)]) for _ in range(12)]
        forest = brute.Union(len(sets))
        for i, j in ngram_jaccard.sketch_links(np.array([len(s) for s in sets]), [ngram_jaccard.sketch(s) for s in sets], 80):
            forest.join(i, j)
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    assert forest.root(i) == forest.root(j)


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100 + r.randrange(50), 100 + r.randrange(50)) for _ in range(40)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    up: dict[int, int] = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in up}


def test_words_and_shingles_follow_the_rule():
    texts = ["A b\tc  D e f", "", "x", "é z   q\x1fr\x0bs T", "\n\n a"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, ends, hashes, bounds = _text.words(np.frombuffer(data, np.uint8), offsets)
    got = [[brute.low(data[s:e].decode()) for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(bounds, bounds[1:])]
    assert got == [brute.words(t) for t in texts]
    _, at = _text.shingles(hashes, bounds, 5)
    assert np.diff(at).tolist() == [2, 0, 1, 1, 1]
