from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest
from compare import SMALL, TINY

from tidemark.llm import quality, queries, toxicity

MODELS = [("op3_quality_classifier", "quality", 3, 1, quality), ("op10_toxicity", "toxic", 5, 0, toxicity)]


def auc(score: np.ndarray, y: np.ndarray) -> float:
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize(("name", "label", "modulus", "remainder", "_"), MODELS)
def test_held_out_accuracy(spark, name, label, modulus, remainder, _):
    out = queries.QUERIES[name](spark, SMALL).toPandas().set_index("doc_id")
    assert len(out) == duckdb.sql(f"select count(*) from '{SMALL}/documents.parquet'").fetchall()[0][0]
    assert list(out["held_out"]) == [zlib.crc32(str(d).encode()) % modulus == remainder for d in out.index]
    assert out["score"].between(0, 1).all() and ((out["score"] >= 0.5) == (out["predicted"] == 1)).all()
    known = duckdb.sql(f"select doc_id, {label} as y from '{SMALL}/labels.parquet' where {label} is not null").df().drop_duplicates("doc_id").set_index("doc_id")["y"]
    own = out[out["held_out"]].join(known, how="inner")
    y = own["y"].to_numpy()
    assert len(y) > 40 and 0 < y.sum() < len(y)
    assert auc(own["score"].to_numpy(), y) > 0.9
    assert (own["predicted"].to_numpy() == y).mean() > 0.85


def frame(spark, module, rows):
    schema = "doc_id long, text string, n_chars long, ids string, label string, __rest int, __text string, __chars int, __score int"
    return spark.createDataFrame([(d, t, len(t or ""), "a", "b", 1, "t", 2, 3) for d, t in rows], schema)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_nulls_repeats_and_single_classes(spark, module):
    good, bad = "a quiet morning by the lake with friends and tea ", "horrid vile curse spit curse vile "
    rows = [(i, (bad if i % 2 else good) * (1 + i % 4)) for i in range(40)] + [(None, bad), (60, None), (61, ""), (62, " \n"), (1, bad), (63, bad * 9000)]
    docs = frame(spark, module, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (5, None), (60, 0), (1, 1)], "doc_id long, label int")
    model = module.fit(docs, labels)
    out = module.score(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert all((r["score"] >= 0.5) == bool(r["doc_id"] % 2) for r in out if r["doc_id"] is not None and r["doc_id"] < 60)
    assert set(docs.columns) <= set(module.score(docs, model).columns)
    for only in (0, 1):
        one = module.fit(docs, labels.where(f"label = {only}"))
        assert all((r["score"] >= 0.5) == bool(only) for r in module.score(docs, one).collect())
    none = module.fit(docs, labels.limit(0))
    assert {r["score"] for r in module.score(docs, none).collect()} == {0.5}
    assert module.score(docs.limit(0), model).collect() == []


def test_without_toxic_keeps_rows_whole(spark):
    docs = frame(spark, toxicity, [(1, "a"), (2, None), (2, None)])
    kept = toxicity.without_toxic(docs, toxicity.NgramModel(np.zeros(1 << toxicity.BITS), -1.0))
    assert kept.columns == docs.columns and kept.count() == 3
    assert toxicity.without_toxic(docs, toxicity.NgramModel(np.zeros(1 << toxicity.BITS), 1.0)).count() == 0


def test_pairwise_sum_is_the_sum_of_squares_identity():
    r = np.random.default_rng(0)
    m = quality.Machine(words=50)
    m.w0, m.w, m.v = 0.3, r.normal(size=m.w.shape), r.normal(size=m.v.shape)
    dense = r.normal(size=(1, quality.N_DENSE))
    word, share = np.array([3, 9, 20]), np.array([0.2, 0.5, 0.3])
    x = np.zeros(50 + quality.N_DENSE)
    x[word] = share
    x[50:] = m.scaled(dense)[0]
    want = m.w0 + x @ m.w + sum((m.v[i] @ m.v[j]) * x[i] * x[j] for i in range(len(x)) for j in range(i))
    assert np.isclose(m.margin(dense, np.zeros(3, int), word, share)[0], want)


ODD_TEXTS = ["Ab ab\tCD", "", "a", "\u00fcn\u00ef \u6f22\u5b57\u6f22\u5b57 \U0001f642\U0001f642\U0001f642 \u00e9", " \n", "\u0434\u0430 \u0434\u0430\u0434\u0430", "ab " * 50, "\u6f22", "x\u00fc"]


def brute_grams(text: str) -> list[str]:
    padded = " " + "".join(" " if c in "\t\n\v\f\r" else c.lower() if "A" <= c <= "Z" else c for c in text) + " "
    return [g for n in toxicity.SIZES for i in range(len(padded) - n + 1) if " " not in (g := padded[i : i + n])[1:-1]]


def test_grams_are_of_characters():
    raw = [t.encode() for t in ODD_TEXTS]
    ids, row = toxicity._grams(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    seen: dict[str, int] = {}
    for i, t in enumerate(ODD_TEXTS):
        own, want = ids[row == i], brute_grams(t)
        assert len(own) == len(want)
        alone = {g: toxicity._grams(np.frombuffer(g.encode(), np.uint8), np.array([0, len(g.encode())])) for g in set(want) if " " not in g}
        for g, (inner, _) in alone.items():  # a gram's id is the same wherever it lies
            k = next(k for k, x in enumerate(brute_grams(g)) if x == g)
            assert seen.setdefault(g, int(inner[k])) == int(inner[k]) and want.count(g) <= (own == inner[k]).sum()
        assert len(set(own.tolist())) == len(set(want))


def test_log_count_ratios_equal_brute_force(spark):
    r = np.random.default_rng(2)
    rows = [(" ".join(r.choice(["vile", "tea", "\u6f22\u5b57", "lake", "curse"], 4, p=[0.3, 0.1, 0.1, 0.1, 0.4] if i % 2 else [0.1, 0.3, 0.3, 0.2, 0.1])), int(i % 2)) for i in range(60)] + [(None, 1), ("", 0)]
    n, texts = toxicity.class_counts(spark.createDataFrame(rows, "text string, label long").repartition(5))
    assert texts.tolist() == [31, 31]
    ratio = toxicity.log_count_ratios(n, texts)
    where: dict[str, int] = {}
    for t, _ in rows:
        raw = (t or "").encode()
        ids, _ = toxicity._grams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        where |= dict(zip(brute_grams(t or ""), ids.tolist()))
    assert n.sum() == sum(len(set(brute_grams(t or ""))) for t, _ in rows) and len(set(where.values())) == len(where)
    for g, i in where.items():
        held = [sum(g in brute_grams(t or "") for t, y in rows if y == c) for c in (0, 1)]
        assert n[:, i].tolist() == held
        want = np.log((held[1] + 1) / 33) - np.log((held[0] + 1) / 33)
        assert np.isclose(ratio[i], want if abs(want) >= toxicity.MIN_Z * np.sqrt(1 / (held[0] + 1) + 1 / (held[1] + 1)) else 0)
    assert len(queries.op10_toxicity(spark, TINY).collect()) == 200


def test_statistics_are_those_of_all_rows(spark):
    rows = [("a b c" * i, float(i)) for i in range(1, 30)] + [(None, None)]
    mean, spread = quality.statistics_scale(spark.createDataFrame(rows, "text string, n_chars double").repartition(3))
    raw = [(t or "").encode() for t, _ in rows]
    dense = quality.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), np.array([n or 0.0 for _, n in rows]))[0]
    assert np.allclose(mean, dense.mean(0)) and np.allclose(spread, dense.std(0) + 1e-6)
