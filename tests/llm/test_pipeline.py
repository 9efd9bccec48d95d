"""The pipeline's stages over a table with planted cases, each against brute force on its own input."""

from __future__ import annotations

import os
import random
from collections import defaultdict

import brute
import pytest

pipeline = pytest.importorskip("corpus_pipeline")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(8)
    items = [(i, " ".join(brute.prose(r, 30, 10**5))) for i in range(5)]
    docs, labels = [], []

    def add(text, toxic=None):
        docs.append((len(docs), text, "en", "s", len(text) if text is not None else None))
        if toxic is not None:
            labels.append((docs[-1][0], 1, toxic))

    for i in range(80):
        words = brute.prose(r, 90, 3000)
        if i % 4 == 0:
            words[::3] = [r.choice(["vile", "scum", "filth", "curse"]) for _ in words[::3]]
        add(" ".join(words), int(i % 4 == 0))
    block = "\n".join(" ".join(brute.prose(r, 9, 3000)) for _ in range(4))
    for i in range(6):
        add(" ".join(brute.prose(r, 60, 3000)) + "\n" + block + "\nend %d" % i)
    near = brute.prose(r, 150, 3000)
    for i in range(5):
        copy = list(near)
        copy[r.randrange(150)] = "new%d" % i
        add(" ".join(copy))
    for i, t in items:
        add(" ".join(brute.prose(r, 50, 3000)) + " " + t + " tail")
    add(None)
    add("")
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, items, dict((d, t) for d, _, t in labels)


def test_each_stage_on_its_own_input(spark, folder):
    path, docs, items, toxic = folder
    now = spark.read.parquet(os.path.join(path, "documents.parquet"))
    columns = now.columns
    for k, (name, stage) in enumerate(pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in now.collect()}
        out = pipeline.kept(stage(spark, now, path))
        if name == "packing":
            pieces = defaultdict(int)
            for p in out.collect():
                pieces[p["doc_id"]] += p["length"]
            assert set(pieces) == set(before)
            break
        assert out.columns == columns
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        rows = sorted(before.items())
        if name == "toxicity":
            assert set(before) - set(after) == {d for d, t in toxic.items() if t}
        elif name == "line_dedup":
            want = brute.without_runs(rows)
            assert after == {d: want[d, t] for d, t in rows if not t or want[d, t].strip()}
            assert all(r["n_chars"] == len(r["text"]) for r in out.where("text is not null").collect())
            assert sum(before[d] != after[d] for d in after) == 5
        elif name == "ngram_jaccard":
            assert set(after) == {c for _, _, c in brute.jaccard(rows)} and len(before) - len(after) == 4
        elif name == "decontamination":
            assert set(before) - set(after) == {d for d, *_ in brute.contained(rows, items)} and len(before) - len(after) == 5
        assert all(after[d] == before[d] for d in after) or name == "line_dedup"
        now = out


def test_run_equals_its_stages_and_the_query(spark, folder):
    import __spark_entry__

    out = __spark_entry__.queries()["pipeline"](spark, folder[0])
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    now = spark.read.parquet(os.path.join(folder[0], "documents.parquet"))
    for _, stage in pipeline.STAGES:
        now = pipeline.kept(stage(spark, now, folder[0]))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = sorted(map(tuple, out.select(columns).collect()))
    assert rows == sorted(map(tuple, now.select(columns).collect())) and len(rows) > 60
    held = defaultdict(list)
    for r in out.collect():
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in held.values():  # gapless and within the capacity
        ends = [0, *(sum(n for _, n in sorted(own)[: k + 1]) for k in range(len(own)))]
        assert [at for at, _ in sorted(own)] == ends[:-1] and ends[-1] <= 1024


def test_stages_of_an_empty_table(spark, folder, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, folder[0]).collect() == []
