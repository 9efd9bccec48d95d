"""The Merkle manifest and the divergence audit against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from compare import TINY, same_as_sql
from pyspark.sql import functions as F

from tidemark.llm import divergence, merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def with_paths(nodes):
    """(root, siblings of every node as (left, right) a level) of a list of digests."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
            paths[k].append(("".join(run[: p % 16]), "".join(run[p % 16 + 1 :])))
        nodes, at = [digest("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)], [p // 16 for p in at]
    return nodes[0], paths


def low(text):
    return None if text is None else re.sub("[A-Z]", lambda m: m.group().lower(), text)


def manifest(rows, changed):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: with_paths([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in sources}
    root, tops = with_paths([trees[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        for (_, _, own, row), path in zip(sorted(groups[s], key=lambda x: x[:3]), trees[s][1]):
            whole = path + top
            start = leaf((*row[:4], low(row[4]))) if changed(row) else own
            for left, right in whole:
                start = digest(left + start + right)
            out.append((row[0], own, trees[s][0], root, digest("".join(a + b for a, b in whole)), start, start == root))
    return Counter(out)


def fifth(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0


def tampered():
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.lower_cased(F.col("text")))


def test_manifest_equals_plain_trees(spark, monkeypatch):
    monkeypatch.setattr(merkle, "TASK_ROWS", 300)
    r = random.Random(3)
    rows, n = [], 0
    for source, size in ((None, 3), ("", 1), ("a", 16), ("b", 17), ("Z", 256), ("é", 257), ("one", 1), ("hot", 4400), *((f"s{k}", 1) for k in range(300))):
        for _ in range(size):
            n += 1
            rows.append((n * 7 % 100_003, source, r.choice(["en", None]), n, r.choice(["Ab", "", None, "ÄB", "x:1"])))
    rows += [rows[5]] * 900 + [(None, "a", "en", 1, "N"), (None, None, None, None, None), (rows[9][0], rows[9][1], "de", 2, "Other")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"at": F.lit(1), "leaf": F.lit("x"), "of": F.lit(2)})
    out = merkle.manifest(docs, tampered())
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got, want = Counter(map(tuple, out.collect())), manifest(rows, fifth)
    assert got == want
    assert {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [1, 1], [4097], []])
def test_manifest_of_small_and_uneven_tables(spark, sizes):
    rows = [(k, f"s{s}", "en", 1, "Text") for s, size in enumerate(sizes) for k in range(size)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert Counter(map(tuple, merkle.manifest(docs, tampered()).collect())) == (manifest(rows, fifth) if rows else Counter())
    if rows:
        assert all(r["verified"] for r in merkle.manifest(docs).collect())


def test_climb_gives_each_node_its_siblings():
    nodes = [digest(str(k)) for k in range(1000)]
    paths = [[] for _ in nodes]
    root = merkle.climb(nodes, merkle.height(0, len(nodes)), paths)
    assert (root, paths) == with_paths(nodes)
    assert all(merkle.fold(n, p) == root for n, p in zip(nodes, paths))
    assert [merkle.height(0, n) for n in (1, 2, 16, 17, 256, 257, 4096)] == [0, 1, 1, 2, 2, 3, 3] and merkle.height(1, 1) == 3


def audited(rows, least=10, top=10):
    docs = [(lang or "", source or "", [t.lower() if t.isascii() else re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df, total, held = Counter(), Counter(), defaultdict(Counter)
        for own, source, terms in docs:
            if own == lang:
                df.update(set(terms))
                held[source].update(terms)
        kept = [t for t in df if df[t] >= least]
        for source in held:
            total.update({t: held[source][t] for t in kept})
        v = len(kept)
        sums = {s: sum(held[s][t] for t in kept) for s in held}
        p = {s: {t: 1 + 10**9 * (held[s][t] + 2) // (sums[s] + 2 * v) for t in kept} for s in held}
        q = {t: 1 + 10**9 * (total[t] + 2) // (sum(sums.values()) + 2 * v) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in held:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in held if o != s]
            marks = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if held[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -x, k + 1) for k, (x, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -x, k + 1) for k, (x, _, t) in enumerate(sorted(marks)[:top])]
    return sorted(out)


def test_audit_equals_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_ROWS", 700)
    r = random.Random(4)
    vocabulary = [f"w{''.join(r.choices('abcé', k=4))}" for _ in range(80)]
    rows = []
    for source in range(150):  # more than two tiles
        for _ in range(r.randrange(1, 6)):
            words = r.choices(vocabulary, weights=[1 / (k + 1) for k in range(80)], k=r.randrange(0, 60))
            rows.append(("en", f"s{source}", "THE, Und-" + " ".join(w.upper() if r.random() < 0.3 else w for w in words) + " 12 ß漢"))
    rows += [(None, None, None), (None, "b", ""), ("de", "b", "xx yy"), ("de", None, "xx zz"), ("de", "", "xx")] + [("de", "b", "xx xx YY")] * 9 + [("fr", "only", "un deux")] * 10
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4).withColumns({"p": F.lit(1), "term": F.lit("x"), "n": F.lit(2)})
    out = divergence.audit(docs)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, out.collect())) == audited(rows)


def test_sums_do_not_depend_on_batches(monkeypatch):
    r = random.Random(6)
    rows = [(0, 0, g, 10**6 + g, 7) for g in range(70)]
    for kind in (1, 2, 3):
        for tid in range(300):
            for g in sorted(r.sample(range(70), r.randrange(1, 40))):
                rows.append((kind, tid if kind < 3 else 0, g, r.randrange(10**6, 10**8), r.randrange(1, 5)))
    tiles = {(0, 0): lambda g: g < 64, (0, 1): lambda g: True, (1, 1): lambda g: g >= 64}
    given = [(i, j, *row) for (i, j), own in tiles.items() for row in rows if own(row[2])]

    def batches(size):
        for at in range(0, len(given), size):
            cut = given[at : at + size]
            i, j, kind, tid, gid, p, n = (pa.array(np.array(c, dtype=np.int64)) for c in zip(*cut))
            yield pa.RecordBatch.from_arrays([pa.array(["x"] * len(cut)), i, j, pa.array([0] * len(cut), pa.int32()), kind, tid, gid, p, n], names=["lang", "i", "j", "slice", "kind", "tid", "gid", "p", "n"])

    def sums(size):
        return sorted(x for b in divergence._summed(batches(size)) for x in zip(*(c.to_pylist() for c in b.columns)))

    whole = sums(10**6)
    monkeypatch.setattr(divergence, "ROWS", 97)
    monkeypatch.setattr(divergence, "COLUMNS", 11)
    assert sums(61) == whole and len(whole) == 70 * 69 // 2


def test_audit_of_an_empty_table_and_long_texts(spark, monkeypatch):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).collect() == []
    monkeypatch.setattr(divergence, "_SLICE", 50)
    text = b"Ab cd. " * 40 + b"x" * 200 + b" end"
    assert [t for part in divergence.terms_of(text) for t in part] == [b"ab", b"cd"] * 40 + [b"x" * 200, b"end"]


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_source_divergence"])
def test_queries_equal_their_sql(spark, name):
    assert same_as_sql(spark, queries.QUERIES[name], queries.SQL[name], TINY) > 0
