"""Document sources, sinks that never overwrite, and streams against their batch forms."""

from __future__ import annotations

import hashlib
import json

import pytest
from compare import TINY, tidy
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import sequences
from tidemark.sources import documents, files, tables
from tidemark.streaming import words as streams


def test_candidates_in_and_out_of_an_envelope(spark, tmp_path):
    one = {"id": "a", "startFrame": 1, "endFrameExclusive": 9, "topicKey": "t", "scores": {"hook": 1.5}, "rejectionFlags": [], "extra": 1}
    (tmp_path / "array.json").write_text(json.dumps([one, {"id": "b"}]))
    (tmp_path / "envelope.json").write_text(json.dumps({"candidates": [one]}, indent=1))
    (tmp_path / "bad.json").write_text("{nothing")
    (tmp_path / "empty.json").write_text("[]")
    got = sorted((r["file"].rpartition("/")[2], r["idx"], r["id"], r["startFrame"], r["scores"]) for r in documents.read_candidates(spark, str(tmp_path)).collect())
    assert got == [("array.json", 0, "a", 1, {"hook": 1.5}), ("array.json", 1, "b", None, None), ("envelope.json", 0, "a", 1, {"hook": 1.5})]


def test_fingerprints_and_what_to_publish(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"one")
    (tmp_path / "y").write_bytes(b"\x00\xff")
    (tmp_path / "z").write_bytes(b"")
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "w ü%20").write_bytes(b"12345")
    (tmp_path / "deep" / "_hidden").write_bytes(b"no")
    got = {r["file"].rpartition("/")[2]: (r["sha256"], r["size_bytes"], r["error"]) for r in files.fingerprint(spark, str(tmp_path), chunk=2).collect()}
    assert got == {n: (hashlib.sha256(b).hexdigest(), len(b), None) for n, b in {"x": b"one", "y": b"\x00\xff", "z": b"", "w ü%20": b"12345"}.items()}
    assert [r["size_bytes"] for r in files.fingerprint(spark, str(tmp_path / "x")).collect()] == [3]
    with pytest.raises(FileNotFoundError):
        files.fingerprint(spark, str(tmp_path / "none"))
    wanted = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "name string, sha256 string")
    there = spark.createDataFrame([("a", "1"), ("b", "9")], "name string, sha256 string")
    assert sorted(r["name"] for r in documents.to_publish(wanted, there).collect()) == ["b", "c"]


def test_fingerprint_of_a_file_larger_than_an_array(spark, tmp_path):
    """3 GiB, most of them a hole: its hash, and no worker that held much of it."""
    with open(tmp_path / "large", "wb") as f:
        f.write(b"head")
        f.truncate(3 << 30)
    digest, zeros = hashlib.sha256(b"head"), bytes(1 << 24)
    for _ in range(191):
        digest.update(zeros)
    digest.update(zeros[4:])
    row = files.fingerprint(spark, str(tmp_path)).first()
    assert (row["sha256"], row["size_bytes"]) == (digest.hexdigest(), 3 << 30)

    def peak(batches):
        import resource

        import pyarrow as pa

        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024])], names=["mb"])

    assert max(r["mb"] for r in spark.range(64).repartition(8).mapInArrow(peak, "mb long").collect()) < 1500


def test_unreadable_documents_are_rows(spark, tmp_path):
    word, frame = {"word": "a", "start": 0, "end": 1.5, "more": [1]}, {"frame": 0, "crop": {"x": 0, "y": 0, "width": 9, "height": 16}}
    contract = {"id": "c", "timeline": {"width": 9, "materialized": {"width": 4}}}
    texts = {
        "transcript": {"good": [word, {"word": "b"}], "none": [], "object": {"word": "a"}, "type": [word | {"end": "x"}]},
        "candidates": {"list": [{"id": "a"}], "envelope": {"candidates": [{"id": "a"}, {"id": "b"}]}, "type": [{"startFrame": 1.5}], "other": {"x": 1}},
        "contract": {"good": contract, "lacking": {"id": "c"}},
        "manifest": {"good": {"source": {"path": "a"}, "output": {"width": 9, "height": 16}, "frames": [frame]}, "lacking": {"source": {}, "output": {"width": 9}}},
    }
    raw = {"empty": b"", "cut": b'[{"word": "a"', "more": b'[] , "x": 1', "bytes": b"\xff[]", "large": b"[" + b" " * 3000 + b"]"}
    want = {
        "transcript": {"good": None, "none": None, "object": "not a transcript: a field has another type", "type": "not a transcript: a field has another type"},
        "candidates": {"list": None, "envelope": None, "type": "not a candidates: a field has another type", "other": "not a candidates: a field has another type"},
        "contract": {"good": None, "lacking": "no field timeline"}, "manifest": {"good": None, "lacking": "no field output.height"},
    }
    for kind, documents_ in texts.items():
        (tmp_path / kind).mkdir()
        for name, value in documents_.items():
            (tmp_path / kind / f"{name}.json").write_text(json.dumps(value))
        for name, value in raw.items():
            (tmp_path / kind / f"{name}.json").write_bytes(value)
        out = {r["file"].rpartition("/")[2][:-5]: r for r in documents.read_documents(spark, str(tmp_path / kind), kind, most=2000).collect()}
        errors = {n: r["error"] for n, r in out.items()}
        assert {n: e for n, e in errors.items() if n not in raw} == want[kind]
        assert {n: (errors[n] or "")[:8] for n in raw} == {"empty": "empty fi", "cut": "not JSON", "more": "not JSON", "bytes": "not UTF-", "large": "over 200"}
        assert all((r["document"] is None) == (r["error"] is not None) for r in out.values())
    read = documents.read_documents(spark, str(tmp_path / "transcript"), "transcript")
    assert sorted((r["source_id"].rpartition("/")[2], r["idx"], r["word"], r["start_ms"], r["end_ms"]) for r in documents.words_of(read).collect()) == [("good.json", 0, "a", 0, 1500), ("good.json", 1, "b", None, None)]
    assert documents.set_aside(read).count() == 6


def test_imports_write_back_what_they_judged(spark, tmp_path):
    def manifest(total, x=0.0):
        return {"source": {"path": "a"}, "zz": {"b": 1, "a": 2}, "status": "ready", "video": {"width": 32, "height": 18, "totalFrames": total}, "output": {"width": 9, "height": 16}, "frames": [{"frame": k, "crop": {"x": x, "y": 0, "width": 9, "height": 16}} for k in range(3)]}

    for name, value in {"good": manifest(3), "short": manifest(4), "out": manifest(3, 30.0), "bad": {}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
    read = documents.read_documents(spark, str(tmp_path), "manifest").cache()
    out = documents.imported_documents(read, "now")
    assert files.write_texts(out) == 3
    got = {n: json.loads((tmp_path / f"{n}.json").read_text()) for n in ("good", "short", "out", "bad")}
    assert got["good"] == manifest(3) | {"validation": {"passed": True, "errors": [], "checkedAt": "now"}, "tier": "external", "status": "review-pending", "updatedAt": "now"}
    assert got["short"]["status"] == "failed" and got["short"]["validation"]["errors"] == ["expected 4 records, found 3"] and got["out"]["validation"]["errors"] == ["frame 0: crop exceeds source bounds"] and got["bad"] == {}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["bad.json", "good.json", "out.json", "short.json"]
    probed = spark.createDataFrame([(r["file"], 32, 18, 4) for r in read.collect()], "source_id string, w int, h int, total long")
    assert {r["file"].rpartition("/")[2]: r["passed"] for r in documents.imported_documents(read, "now", probed).collect()} == {"good.json": False, "short.json": False, "out.json": False}
    read.unpersist()


def test_canonical_json_does_not_depend_on_the_order_of_fields(spark):
    a = spark.sql("select named_struct('y', 1, 'x', array(named_struct('b', cast(null as int), 'a', map('k', named_struct('q', 1, 'p', 2), 'c', null)))) as n, 'é' as b, map('z', 1, 'a', 2) as m")
    b = spark.sql("select map('a', 2, 'z', 1) as m, 'é' as b, named_struct('x', array(named_struct('a', map('c', null, 'k', named_struct('p', 2, 'q', 1)), 'b', cast(null as int))), 'y', 1) as n")
    text = '{"b":"é","m":{"a":2,"z":1},"n":{"x":[{"a":{"c":null,"k":{"p":2,"q":1}},"b":null}],"y":1}}'
    assert [df.select(documents.canonical_json(df)).first()[0] for df in (a, b)] == [text, text] and json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == text


def test_sinks_refuse_to_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(2, "x", None)], "b int, a string, c string")
    documents.write_json(df, f"{tmp_path}/json")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/json").collect()] == ['{"a":"x","b":2,"c":null}']
    with pytest.raises(AnalysisException):
        documents.write_json(df, f"{tmp_path}/json")
    lines = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "source_id long, frame long, line string")
    documents.write_script(lines, f"{tmp_path}/script")
    assert [p.read_text() for p in sorted(tmp_path.glob("script/source_id=1/*.txt"))] == ["a\nb\n"]
    with pytest.raises(AnalysisException):
        documents.write_script(lines, f"{tmp_path}/script")


def test_streamed_repair_equals_batch(spark, tmp_path):
    words = tables.words(spark, TINY)
    third = words.groupBy("source_id").agg((F.max("idx") / 3 + 1).alias("third"))
    own = words.join(third, "source_id").withColumn("part", F.floor(F.col("idx") / F.col("third"))).drop("third").cache()
    for part in range(3):
        own.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(words.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    run = streams.repair_stream(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert tidy(spark.read.parquet(f"{tmp_path}/out").toPandas()) == tidy(sequences.repair(words).toPandas())


def test_streamed_rates_equal_batch(spark, tmp_path):
    events = spark.read.parquet(f"{TINY}/events.parquet").select("ts", "event_type")
    events.orderBy("ts").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = streams.event_rates(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in"), "1 day", "40 days")
    run = stream.writeStream.format("memory").queryName("rates").outputMode("complete").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    run.awaitTermination(120)
    batch = events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").start.alias("start"), "event_type").count().withColumnRenamed("count", "n")
    got = spark.sql("select cast(start as string) as start, event_type, n from rates").toPandas()
    assert tidy(got) == tidy(batch.withColumn("start", F.col("start").cast("string")).toPandas())
