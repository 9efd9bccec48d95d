"""Frames made from stretches between anchors, and crops stepped side by side."""

from __future__ import annotations

import random

import pytest
from compare import TINY

from tidemark.operators import carry, folds, runs, tracks
from tidemark.plans import registry


def test_stretches_are_the_neighbours_of_every_value(spark):
    r = random.Random(1)
    anchors = [(s, h, f, f * 10 + h) for s in (1, None) for h in range(5) for f in range(-30, 60) if r.random() < 0.15 and h]
    ranges = [(s, h, a, z) for s in (1, None) for h in range(5) for a, z in ((-20, 11), (15, 40)) if h != 3]
    want = []
    for s, h, a, z in ranges:
        own = sorted(f for k, g, f, _ in anchors if (k, g) == (s, h))
        at = lambda f: None if f is None else f * 10 + h
        for v in range(a, z + 1):
            want.append((s, h, v, at(max((f for f in own if f < v), default=None)), at(min((f for f in own if f >= v), default=None)), at(own[-1] if own else None)))
    a, z = spark.createDataFrame(anchors, "s long, h long, frame long, anchor long"), spark.createDataFrame(ranges, "s long, h long, first long, last long")
    for span in (7, 1000):
        got = carry.stretches(a, z, ["s", "h"], "frame", "anchor", span).selectExpr("s", "h", "explode(sequence(first, last))", "prev", "next", "final")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", ["crop_frames", "crop_lines", "canvas_transforms"])
def test_frames_are_not_dealt(spark, name):
    plan = registry.queries()[name](spark, TINY)._jdf.queryExecution().executedPlan().toString()
    frames = plan.index("explode(sequence(first")
    assert "Exchange" not in plan[:frames] and plan[:frames].count("Sort [") == 1  # made behind the last exchange, sorted once


def test_crops_do_not_depend_on_batches(spark):
    r = random.Random(2)
    rows = [(s, h, f, r.randrange(10**6), r.randrange(10**6), r.choice([None, r.randrange(10**6)])) for s, h, n in [(1, 1, 200), (1, None, 40), *((2, h, h) for h in range(60))] for f in range(n)]
    own = spark.createDataFrame(rows, "source_id long, shot_id long, frame long, cx long, cy long, box_height long").coalesce(1)
    got = []
    for most in ("7", "100", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
        got.append(sorted(map(tuple, tracks.crop_frames(own, 1920, 1080, 9, 16, zoom=(1.0, 1.25)).collect()), key=repr))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got[0]) == len(rows) and got[0] == got[1] == got[2]


def test_candidates_are_folded_once(spark):
    plan = registry.queries()["rank_reasons"](spark, TINY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan


def test_checked_crops_are_summed_where_they_lie(spark):
    plan = registry.queries()["imported_manifests"](spark, TINY)._jdf.queryExecution().executedPlan().toString()
    dealt = plan[: plan.index("MapInArrow")].rpartition("Exchange")[2]  # what is done with crops before their first exchange
    assert "HashAggregate" in dealt and "Join" not in dealt and "Sort" not in dealt


def test_crops_do_not_depend_on_what_is_gathered(spark, monkeypatch):
    r = random.Random(4)
    rows = [(s, h, f, r.randrange(10**6), r.randrange(10**6), r.choice([None, r.randrange(10**6)])) for s, h, n in [(1, 1, 90), (1, None, 40), *((2, h, h) for h in range(40))] for f in range(n)]
    own = spark.createDataFrame(rows, "source_id long, shot_id long, frame long, cx long, cy long, box_height long").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    got = []
    for together in (1, 12, folds.TOGETHER):
        monkeypatch.setattr(folds, "TOGETHER", together)
        got.append(sorted(map(tuple, tracks.crop_frames(own, 1920, 1080, 9, 16, zoom=(1.0, 1.25)).collect()), key=repr))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got[0]) == len(rows) and got[0] == got[1] == got[2]


@pytest.mark.parametrize("size", [None, 640])
def test_errors_of_tracks(spark, size):
    tracked = {
        1: list(range(200)), 2: [f for f in range(200) if f != 63], 3: [*range(64), 63, *range(65, 200)], 4: list(range(-70, 70)),
        5: [0, 1, None], 6: [None], 7: list(range(130)), 8: list(range(130)), 10: [2**40, 2**40 + 1],
    }
    crop = {(7, 65): (0.0, 0.0, 300.0, 360.0), (7, 64): (500.0, 0.0, 202.5, 360.0), (7, 3): (0.0, 0.0, 202.5, 360.0), (8, 128): (0.0, -1.0, 202.5, 0.0), (8, 129): (0.0, -1.0, 202.5, 360.0)}
    rows = [(s, f, *crop.get((s, f), (10.0, 0.0, 202.5, 360.0))) for s, frames in tracked.items() for f in frames]
    videos = spark.createDataFrame([(s, 640, 360, len(tracked.get(s, ()))) for s in (*tracked, 9)], "source_id long, w int, h int, total long")
    if size:
        videos = videos.drop("w", "h")
    crops = spark.createDataFrame([*rows, (11, 0, 0.0, 0.0, 1.0, 1.0)], "source_id long, frame long, x double, y double, width double, height double").repartition(5)
    got = {r["source_id"]: r["errors"] for r in tracks.track_errors(crops, videos, 9, 16, size, size and 360).collect()}
    gap, start = "frame records are not continuous", "frame records must start at 0"
    assert got == {1: "", 2: gap, 3: gap, 4: start, 5: gap, 6: gap, 7: "frame 64: crop exceeds source bounds", 8: "frame 128: non-positive crop", 9: "no frame records", 10: start}


@pytest.mark.parametrize("name", ["weak_ranges", "reviewed_ranges", "track_counts"])
def test_weak_frames_are_not_made(spark, name):
    assert "explode(sequence(first" not in registry.queries()[name](spark, TINY)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("span", [7, 1 << 15])
def test_stretches_count_as_their_frames(spark, monkeypatch, span):
    monkeypatch.setattr(carry, "SPAN", span)
    r = random.Random(span)
    shots, samples = [], []
    for s in (*range(25), None):
        begin = r.randrange(-20, 20)
        for h in range(r.randrange(1, 5)):
            end = begin + r.randrange(0, 30)
            shots.append((s, h, begin, end))
            samples += [(s, h, f, *((1, 2, 3, 9) if r.random() < 0.9 else (None,) * 4), r.choice([0.0, 0.1, 0.29996, 0.3, 0.9]), "d") for f in range(begin - 3, end + 3) if h and r.random() < r.choice([0.1, 0.4])]
            begin = end + r.choice([0, 0, 6])
    shots = spark.createDataFrame(shots, "source_id long, shot_id long, start_frame long, end_frame long")
    samples = spark.createDataFrame(samples, "source_id long, shot_id long, frame long, x0 int, y0 int, x1 int, y1 int, confidence double, detector string")
    frames, own = tracks.frame_records(shots, samples, 640, 360), tracks.record_stretches(shots, samples)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(own.selectExpr("source_id", "shot_id", "explode(sequence(frame, last_frame))", "confidence", "flags")) == rows(frames.select("source_id", "shot_id", "frame", "confidence", "flags"))
    weak = [tracks.weak_ranges(df, 0.3) for df in (own, frames)]
    assert rows(weak[0]) == rows(weak[1])
    assert rows(runs.track_counts(shots, samples, own, weak[0])) == rows(runs.track_counts(shots, samples, frames, weak[1]))
