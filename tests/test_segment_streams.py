"""Streams of windows and cues against their batch forms, with late words and quiet sources."""

from __future__ import annotations

import pytest
from compare import TINY, tidy
from pyspark.sql import functions as F

from tidemark.operators import sequences
from tidemark.sources import tables
from tidemark.streaming import segments

SCHEMA = "source_id long, idx long, word string, start_ms long, end_ms long, ts timestamp"


@pytest.fixture
def state_store(spark):
    before = spark.conf.get(segments.STORE[0])
    spark.conf.set(*segments.STORE)
    yield
    spark.conf.set(segments.STORE[0], before)


def streamed(spark, parts, folder, build):
    """What a stream over the parts gives, a batch each."""
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in/{k:02d}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    run = build(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    assert run.awaitTermination(240)
    return spark.read.parquet(f"{folder}/out")


def at(ms):
    return F.timestamp_millis(F.lit(1_700_000_000_000) + ms)


@pytest.mark.parametrize("kind", ["cues", "windows"])
def test_streams_equal_batch(spark, tmp_path, state_store, kind):
    words = tables.words(spark, TINY).where("source_id < 6").withColumn("ts", at(F.col("idx") * 1000))
    thirds = [words.where(F.floor(F.col("idx") / 40) == k) for k in range(6)]
    rest = words.where("idx >= 240")
    end = spark.createDataFrame([(-1, 0, "end.", 0, 1)], "source_id long, idx long, word string, start_ms long, end_ms long").withColumn("ts", at(F.lit(10**10)))
    build, batch = {"cues": (segments.cue_stream, sequences.cues), "windows": (segments.window_stream, sequences.semantic_windows)}[kind]
    out = streamed(spark, [*thirds, rest, end], tmp_path, build).where("source_id >= 0")
    want = batch(words.drop("ts"))
    assert want.count() > 20
    assert tidy(out.toPandas()) == tidy(want.select(out.columns).toPandas())


def test_late_words_and_quiet_sources(spark, tmp_path, state_store):
    rows = lambda *own: spark.createDataFrame(list(own), "source_id long, idx long, word string, start_ms long, end_ms long").withColumn("ts", at(F.col("idx") * 1000))
    word = lambda source, idx, text: (source, idx, text, idx * 400, idx * 400 + 390)
    parts = [
        rows(word(1, 2, "two"), word(1, 0, "zero"), word(1, 1, "one"), word(2, 0, "alone")),
        rows(word(1, 3, "three."), word(1, 30, "again")),
        rows(word(1, 4, "late"), word(1, 200, "much")),  # behind the watermark, which 30 has moved to 20
        rows(word(1, 1000, "last")),
        rows(word(3, 100_000, "end")),
    ]
    out = streamed(spark, parts, tmp_path, lambda w: segments.cue_stream(w, "10 seconds", 60_000, pause=10**9, span=10**9))
    got = sorted((r["source_id"], r["number"], r["from_idx"], r["to_idx"], r["text"]) for r in out.collect())
    assert got == [(1, 0, 0, 4, "zero one two three."), (1, 1, 30, 31, "again"), (1, 2, 200, 201, "much"), (1, 3, 1000, 1001, "last"), (2, 0, 0, 1, "alone")]


def test_the_store_must_be_named(spark):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{TINY}/conversations.parquet")
    with pytest.raises(ValueError, match="providerClass"):
        segments.cue_stream(stream)
