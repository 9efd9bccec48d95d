from __future__ import annotations

import random

import brute
import pytest
from brute import prose
from compare import same_as_sql
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, queries, substring_dedup

SCHEMA = "doc_id long, text string"


def lined(seed: int, n: int) -> list[tuple]:
    r = random.Random(seed)
    pool = [f"line {i}" for i in range(30)] + ["", "  ", "\t"]
    rows: list[tuple] = [(1000, None), (1001, ""), (1002, "\n\n"), (None, "line 1\nline 2\nline 3")]
    for d in range(n):
        rows.append((d, "\n".join((" " if r.random() < 0.1 else "") + r.choice(pool) for _ in range(r.randrange(1, 14)))))
    return rows


@pytest.mark.parametrize("least", [1, 2, 3])
def test_line_dedup_equals_brute_force(spark, least):
    rows = lined(least, 40)
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_report(spark.createDataFrame(rows, SCHEMA), least).collect()}
    want = brute.without_runs(rows, least)
    assert got == {d: want[d, t] for d, t in rows}


def test_long_repeats_and_longest(spark):
    run = "\n".join(f"shared {i}" for i in range(37))
    rows = [(1, "a\n" + run + "\nb"), (2, run), (3, "c\n\n" + run), (4, "d")]
    out = {r["doc_id"]: r for r in line_dedup.line_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [out[d]["text"] for d in (1, 2, 3, 4)] == [rows[0][1], "", "c\n", "d"]
    assert out[3]["__longest"] == 37 and out[4]["__longest"] is None


def test_longest_common_prefixes_equal_brute_force(spark):
    r = random.Random(12)
    rows = [(d, "\n".join(r.choice("abc") for _ in range(r.randrange(1, 24)))) for d in range(14)] + [(20, "\n".join("a" * 30))]
    rows += [(d, "\n".join([own, *(f"shared {k}" for k in range(21)), own])) for d, own in ((21, "own 1"), (22, "own 2"))]
    got = {(x["d"]["doc_id"], x["pos"]): x["n_common"] for x in line_dedup.repeated_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    suffixes = [((d, i), t.split("\n")[i:]) for d, t in rows for i in range(len(t.split("\n")))]
    shared = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    first: dict[tuple, list] = {}
    want = {at: shared(own, first[tuple(own[:2])]) for at, own in suffixes if len(own) > 1 and first.setdefault(tuple(own[:2]), own) is not own}
    assert got == want and max(want.values()) > 16


def test_line_dedup_stage_drops_emptied_documents_only(spark):
    rows = [(1, "a\nb", "x"), (2, "a\nb", "y"), (3, "", "z"), (4, None, "q")]
    df = spark.createDataFrame(rows, SCHEMA + ", __lines string")
    assert sorted(r["doc_id"] for r in line_dedup.line_report(df).collect()) == [1, 2, 3, 4]
    out = line_dedup.without_repeated_lines(df)
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4]


def test_line_dedup_of_repeated_rows_and_nothing(spark):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb")]
    out = sorted((r["doc_id"], r["text"]) for r in line_dedup.line_report(spark.createDataFrame(rows, SCHEMA)).collect())
    assert out == [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "")]
    assert line_dedup.line_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_single_lines_between_unique_neighbours(spark):
    r = random.Random(4)
    passage, short = " ".join(prose(r, 50)), " ".join(prose(r, 49))
    rows = [(d, f"own {d}\n{'  ' * d}{passage}\n{short}{' end %d' % d if d % 2 else ''}\nlast {d}") for d in range(1, 5)] + [(6, passage), (7, f"{passage}\nx\n{passage}"), (None, passage)]
    out = {x["doc_id"]: x["text"] for x in line_dedup.without_repeated_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    texts = dict(rows)
    assert out == {1: texts[1], 2: f"own 2\n{short}\nlast 2", 3: f"own 3\n{short} end 3\nlast 3", 4: "own 4\nlast 4", 7: "x", None: passage}


def test_line_dedup_query_equals_sql(spark):
    assert same_as_sql(spark, queries.QUERIES["op8_line_dedup"], queries.SQL["op8_line_dedup"]) == 200


def spoken(seed: int, n: int) -> list[tuple]:
    r = random.Random(seed)
    pool = [" ".join(prose(r, r.randrange(1, 9), 50)) + r.choice([".", "!", "?", '."', "\n"]) for _ in range(18)]
    rows: list[tuple] = [(1000, None), (1001, ""), (1002, "a. b."), (None, " ".join(pool))]
    for d in range(n):
        k = r.randrange(len(pool))
        rows.append((d, " ".join(r.choice(pool) for _ in range(3)) + "  " + (" " if d % 2 else "\n").join((pool + pool)[k : k + r.randrange(1, 9)])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_equals_brute_force(spark, seed):
    rows = spoken(seed, 40)
    got = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect() if r["doc_id"] is not None}
    assert {d: got[d] for d, t in rows if d is not None and t is not None} == brute.without_spans(rows)
    assert got[1000] is None


def test_substring_dedup_of_long_sentences_and_odd_rows(spark):
    r = random.Random(9)
    passage = " ".join(prose(r, 300, 10**6))
    rows = [(1, "Start here. " + passage + " then more of it", "k"), (2, passage, "k"), (2, passage, "k"), (3, "", "k"), (4, None, None)]
    out = [(x["doc_id"], x["text"], x["__removed"]) for x in substring_dedup.without_repeated_spans(spark.createDataFrame(rows, SCHEMA + ", __version string")).collect()]
    assert len(out) == 5
    assert max(len(t) for d, t, _ in out if d == 2) < len(passage) / 4  # nearly all of the later copy goes
    assert next(t for d, t, _ in out if d == 1) == rows[0][1]
    assert substring_dedup.without_repeated_spans(spark.createDataFrame([], SCHEMA)).collect() == []


def test_substring_dedup_of_passages_cut_inside_sentences(spark):
    r = random.Random(11)
    rows, passages = [], []
    for k in range(30):
        words = prose(r, 50, 10**6)
        for stop in range(7 + k % 9, 50, 15 + k % 8):  # sentences of 15 to 22 words
            words[stop] += "."
        passages.append(words)
        for copy in range(2):
            edges = [prose(r, r.randrange(3, 12), 10**6) for _ in range(2)]
            rows.append((100 * copy + k, "Own start here. " + " ".join([*edges[0], *words, *edges[1]]) + ". Own end here."))
    out = {x["doc_id"]: x for x in substring_dedup.without_repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k, words in enumerate(passages):
        assert out[k]["text"] == dict(rows)[k] and out[k]["__removed"] == 0
        left = out[100 + k]["text"].split()
        assert 0 < out[100 + k]["__removed"] <= out[100 + k]["__sentences"]
        assert sum(w not in left for w in words) >= 20 and all(w in left for w in dict(rows)[100 + k].split() if w not in words)


def test_substring_dedup_of_one_repeated_word(spark):
    rows = [(1, "a " * 60), (2, "b " + "a " * 60 + "c")]
    out = {x["doc_id"]: x["text"].split() for x in substring_dedup.without_repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert 0 < len(out[1]) <= 60 and len(out[2]) < 25 and {"b", "c"} <= set(out[2])


def test_substring_dedup_query(spark):
    out = queries.op1_substring_dedup(spark, "/root/testdata/sf0.001").toPandas()
    assert len(out) == 200 and (out["n_removed"] > 0).any() and (out["n_removed"] <= out["n_sentences"]).all()


def test_decontamination_equals_brute_force(spark):
    r = random.Random(2)
    items: list[tuple] = [(i, " ".join(prose(r, n))) for i, n in enumerate([1, 2, 4, 5, 6, 9, 20, 40, 41, 90, 200])] + [(50, None), (51, ""), (None, "a b"), (6, "w1 w2 w3")]
    docs: list[tuple] = [(100, None), (101, " "), (102, "w1"), (None, items[6][1])]
    for d in range(60):
        text = prose(r, r.randrange(0, 60))
        passage = r.choice(items[:11])[1].split()
        for _ in range(d % 5):
            passage[r.randrange(len(passage))] = "changed"
        docs.append((d, " ".join([*text, *passage[: max(1, len(passage) - d % 3)], *text[:9]])))
    got = decontaminate.contained_items(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    want = brute.contained(docs, items)
    assert {tuple(x) for x in got.collect()} == want and want
    blocks = decontaminate.contained_items(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), block=60)
    assert {tuple(x) for x in blocks.collect()} == want


def test_decontamination_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contained_items(none, items).collect() == []
    docs = spark.createDataFrame([(1, "a b c d e f", 2), (2, "a b c", 2), (None, None, None)], SCHEMA + ", item_id int")
    assert decontaminate.without_items(docs, items.limit(0)).count() == 3
    left = decontaminate.without_items(docs, items)
    assert left.columns == docs.columns and left.where("doc_id = 1").count() == 0 and left.count() == 2


def test_decontamination_query_equals_sql(spark):
    assert same_as_sql(spark, queries.QUERIES["op5_benchmark_decontamination"], queries.SQL["op5_benchmark_decontamination"]) > 0


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    item = " ".join(f"w{k}" for k in range(12))
    rows = [(1, "before it " + item, "a"), (1, "all clean words here and more", "b"), (None, item, "c"), (2, None, "d"), (1, "before it " + item, "e"), (3, item, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __hit string")
    left = decontaminate.without_items(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert left.columns == docs.columns and sorted(r["__hit"] for r in left.collect()) == ["b", "c", "d"]


def test_report_with_clashing_columns(spark):
    rows = [(1, "aa bb\ncc dd\nee", "x", 1), (2, "aa bb\ncc dd\nff", "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __doc string, __parts int").withColumns({"__h": F.lit(1), "__lines": F.lit(0), "raw": F.lit(2), "__rest": F.lit(3)})
    out = line_dedup.line_report(docs)
    assert out.columns == ["doc_id", "text", "__doc", "__parts", "__h", "raw", "__rest", "__lines", "__longest"]
    assert sorted((r["doc_id"], r["text"], r["__doc"], r["__lines"], r["__longest"]) for r in out.collect()) == [(1, rows[0][1], "x", None, None), (2, "ff", "y", [0, 1], 2)]


def test_lines_of_two_name_all_lines_of_longer_runs(spark):
    """The lines under later copies of whole maximal runs are those under later copies of their stretches of `min_lines`: each line of a later
    run lies in such a stretch inside the run, which occurs before; and a later stretch is itself part of a later maximal run."""
    r = random.Random(12)
    rows = [(d, "\n".join(r.choice("abcdef") * 3 for _ in range(r.randrange(1, 25)))) for d in range(30)]
    texts = {d: t.split("\n") for d, t in rows}
    for least in (2, 3):
        gone = {d: set() for d in texts}
        places = [(d, k) for d in sorted(texts) for k in range(len(texts[d]))]
        for d, k in places:
            longest = 0
            for e, j in places:
                if (e, j) < (d, k):
                    n = 0
                    while k + n < len(texts[d]) and j + n < len(texts[e]) and texts[d][k + n] == texts[e][j + n]:
                        n += 1
                    longest = max(longest, n)
            if longest >= least:
                gone[d] |= set(range(k, k + longest))
        got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string"), least)
        assert {x["doc_id"]: set(x["__lines"] or ()) for x in got.collect()} == gone
