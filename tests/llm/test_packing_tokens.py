from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from brute import prose
from tokenizers import Tokenizer

from tidemark.llm import packing, queries, token_counts

SCHEMA = "doc_id long, text string"
ODD = ["", "a", "  two  blanks ", "<|endoftext|>", "x<|endoftext|>y <|endoftext|>", "Ünï 漢字 🙂🙂 é", "tab\tand\r\nline\x0bend\x00", "don't we'll 12345 !!!", "a" * 5000, "   x", " " * 3000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def rows() -> list[tuple]:
    r = random.Random(3)
    out: list[tuple] = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (None, "no id"), (51, "same"), (51, "same")]
    out += [(100 + i, " ".join(prose(r, r.randrange(1, 400), 10**4))) for i in range(120)]
    out.append((300, " ".join(prose(r, 2500, 10**4))))
    return out


def whole(out, docs, tokenizer, capacity):
    """Asserts that pieces are the documents' ids and that sequences are gapless and within capacity; returns how many there are."""
    want = defaultdict(list)
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want[d].append(ids)
    got = defaultdict(list)
    bins = defaultdict(list)
    for p in out:
        got[p["doc_id"]].append((p["piece"], p["start"], p["length"], p["ids_crc32"]))
        bins[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(got) == set(want)
    for d, copies in want.items():
        expected = []
        for ids in copies:
            flat = np.array(ids, "<u4")
            edges = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
            expected += [(i, a, b - a, zlib.crc32(flat[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
        assert sorted(got[d]) == sorted(expected)
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_sequences_are_whole(spark, tokenizer):
    docs = rows()
    out = packing.pack_documents(spark.createDataFrame(docs, SCHEMA)).collect()
    n = whole(out, docs, tokenizer, 1024)
    assert n <= 1 + packing.lower_bound(np.array([p["length"] for p in out]), 1024) * 1.02


def test_rounds_of_small_partitions(spark, tokenizer):
    docs = rows()
    pieces = packing.pieces(spark.createDataFrame(docs, SCHEMA), capacity=300).cache()
    out = packing.packed(pieces, 300, partition_pieces=12).collect()
    assert whole(out, docs, tokenizer, 300) <= 1.15 * packing.lower_bound(np.array([p["length"] for p in out]), 300)


def test_query_over_the_table(spark, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op9_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    n = whole(out, docs, tokenizer, 1024)
    assert n <= packing.lower_bound(np.array([p["length"] for p in out]), 1024) + 1


def test_very_long_texts(spark, tokenizer):
    docs = [(1, " " * 1_000_000), (2, "ab" * 300_000), (3, "x" + "\n" * 400_000 + "<|endoftext|>"), (4, "word " * 200_000)]
    df = spark.createDataFrame(docs, SCHEMA)
    whole(packing.pack_documents(df).collect(), docs, tokenizer, 1024)
    counts = {r["id"]: r["n_tokens"] for r in token_counts.section_tokens(df, "doc_id", ["text"]).collect()}
    assert counts == {d: len(tokenizer.encode(t, add_special_tokens=False).ids) for d, t in docs}


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_best_fit_decreasing_and_its_bound():
    r = np.random.default_rng(1)
    for _ in range(60):
        n = int(r.integers(1, 9))
        lengths = r.integers(1, 21, n)
        _, _, made = packing.best_fit_decreasing(lengths, 20)
        bound = packing.lower_bound(lengths, 20)
        best = n

        def place(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == n:
                best = len(rooms)
                return
            for k in range(len(rooms)):
                if rooms[k] >= lengths[i]:
                    place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
            place(i + 1, [*rooms, 20 - lengths[i]])

        place(0, [])
        assert bound <= best <= made


@pytest.mark.parametrize("rule", ["first", "most"])
def test_token_counts_equal_offsets(spark, tokenizer, rule):
    docs = [(i, t, u) for (i, t), (_, u) in zip(rows(), reversed(rows()))]
    got = defaultdict(dict)
    seen = set()
    unique = [d for d in docs if d[0] is not None and not (d[0] in seen or seen.add(d[0]))]
    for r in token_counts.section_tokens(spark.createDataFrame(unique, "id long, text string, title string"), "id", ["title", "text"], by_line=True, rule=rule).collect():
        got[r["id"]][r["field"], r["section"]] = (r["start"], r["end"], r["n_tokens"], r["n_crossing"])
    tokenizer.encode_special_tokens = False
    for i, text, title in unique:
        lines = [("title", k, x) for k, x in enumerate((title or "").split("\n"))] + [("text", k, x) for k, x in enumerate((text or "").split("\n"))]
        edges = [0]
        for k, (_, _, x) in enumerate(lines):
            edges.append(edges[-1] + len(x) + (k < len(lines) - 1))
        n, crossing = [0] * len(lines), [0] * len(lines)
        full = (title or "") + "\n" + (text or "")
        for a, b in tokenizer.encode(full, add_special_tokens=False).offsets:
            held = [max(0, min(b, y) - max(a, x)) for x, y in zip(edges, edges[1:])]
            first = next(k for k, v in enumerate(held) if v)
            own = first if rule == "first" else held.index(max(held))
            n[own] += 1
            crossing[own] += sum(v > 0 for v in held) > 1
        want = {(f, s): (edges[k], edges[k + 1], n[k], crossing[k]) for k, (f, s, _) in enumerate(lines)}
        assert got[i] == want, (i, text)


def test_token_query_counts_every_token(spark, tokenizer):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = queries.op7_token_counts(spark, "/root/testdata/sf0.001").toPandas()
    total = out.groupby("doc_id")["n_tokens"].sum().to_dict()
    assert total == {d: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for d, t in docs.items()}
    assert token_counts.section_tokens(spark.createDataFrame([], SCHEMA), "doc_id", ["text"]).collect() == []
