"""Scans in chunks, prefix sums and the index of kept ranges against plain loops."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import carry, ranking, sequences, shots, tracks
from tidemark.operators.intervals import Kept

TRACK = "source_id long, shot_id long, frame long, cx long"


@pytest.fixture
def short_chunks(monkeypatch):
    monkeypatch.setattr(carry, "SPAN", 7)


def keyed(rows, n=2):
    out = {}
    for row in sorted(rows, key=lambda r: tuple((v is not None, v) for v in r[:n]) + r[n:]):
        out.setdefault(row[:n], []).append(row[n:])
    return out


def test_running_max_and_repair_over_chunks(spark, short_chunks):
    r = random.Random(1)
    rows = [(s, k, "w", r.randrange(60) * 10 + k, r.randrange(60) * 10 + k) for s in (1, 2, None) for k in range(r.randrange(20, 60))]
    words = spark.createDataFrame(rows, "source_id long, idx long, word string, start_ms long, end_ms long").repartition(3)
    want = []
    for (s,), own in keyed(rows, 1).items():
        end = 0
        for k, w, a, z in own:
            a = max(a, end)
            end = max(z, a + 10)
            want.append((s, k, w, a, end))
    got = [tuple(x) for x in sequences.repair(words).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_word_errors_over_chunks(spark, short_chunks):
    r = random.Random(2)
    rows = [(s, k, r.choice(["w", " "]), r.choice([None, k * 10, k * 10 - 25]), k * 10 + r.choice([-3, 5])) for s in (1, 2) for k in range(40)]
    words = spark.createDataFrame(rows, "source_id long, idx long, word string, start_ms long, end_ms long")
    want = []
    for (s,), own in keyed(rows, 1).items():
        ps = pe = None
        for k, w, a, z in own:
            if not w.strip():
                want.append((s, k, "blank word"))
            if a is None:
                want.append((s, k, "times must be finite"))
                continue
            if a < 0 or z <= a:
                want.append((s, k, "invalid range"))
            if ps is not None and (a < ps or z < pe):
                want.append((s, k, "not monotonic"))
            ps, pe = a, z
    assert sorted(map(tuple, sequences.word_errors(words).collect())) == sorted(want)


def test_weak_ranges_over_chunks(spark, short_chunks):
    r = random.Random(3)
    rows = []
    for s in range(12):
        frame = r.randrange(-30, 5)
        for _ in range(r.randrange(1, 80)):
            rows.append((s, frame, r.choice([0.1, 0.9]) if s % 3 else 0.1))
            frame += r.choice([1, 1, 1, 2, 40]) if s % 2 else 1
    want = []
    for (s,), own in keyed(rows, 1).items():
        begun = None
        for frame, c in own:
            if c < 0.3 and begun is None:
                begun = frame
            elif c >= 0.3 and begun is not None:
                want.append((s, begun, frame))
                begun = None
        if begun is not None:
            want.append((s, begun, own[-1][0] + 1))
    got = tracks.weak_ranges(spark.createDataFrame(rows, "source_id long, frame long, confidence double").repartition(4), 0.3)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_neighbours_over_chunks(spark, short_chunks):
    r = random.Random(4)
    rows = [(s, h, f, r.choice([None, None, r.randrange(900)])) for s in (1, None) for h in range(4) for f in range(-10, 40) if r.random() < 0.9 and h]
    own = carry.neighbours(spark.createDataFrame(rows, TRACK).repartition(3), ["source_id", "shot_id"], ["frame"], "cx")
    want = []
    for key, track in keyed(rows).items():
        known = [x for _, x in track if x is not None]
        for i, (f, x) in enumerate(track):
            prev = [v for _, v in track[:i] if v is not None]
            later = [v for _, v in track[i:] if v is not None]
            want.append((*key, f, x, prev[-1] if prev else None, later[0] if later else None, known[-1] if known else None))
    assert sorted(map(tuple, own.select("source_id", "shot_id", "frame", "cx", "prev", "next", "final").collect()), key=repr) == sorted(want, key=repr)


def test_cuts_over_chunks(spark, short_chunks):
    kinds = {0: "pts_time:%d.0 x", 1: "scene_score=1", 2: "chatter"}
    r = random.Random(5)
    rows = [(s, n, kinds[k] % n if k == 0 else kinds[k]) for s in (1, 2) for n in range(1, 90) for k in [r.randrange(3)]]
    want = set()
    for (s,), own in keyed(rows, 1).items():
        armed = None
        for n, line in own:
            if "pts_time" in line:
                armed = n
            elif "scene" in line and armed is not None:
                want.add((s, armed * 25))
                armed = None
    assert set(map(tuple, shots.cuts_from_log(spark.createDataFrame(rows, "source_id long, line_no long, line string"), 25).collect())) == want


def test_dead_zone_is_the_fold_and_is_spread(spark):
    r = random.Random(6)
    rows = [(s, h, f, r.randrange(1000)) for s, h, n in ((1, 1, 300), (1, 2, 1), (2, None, 45)) for f in range(5, 5 + n)]
    want = []
    for key, track in keyed(rows).items():
        at = None
        for f, v in track:
            at = v if at is None else min(max(at, v - 60), v + 60)
            want.append((*key, f, at))
    df = spark.createDataFrame(rows, TRACK).repartition(3)
    for span in (1, 7, 10_000):
        assert sorted(map(tuple, tracks.dead_zone(df, 60, span=span).collect()), key=repr) == sorted(want, key=repr)
    one = spark.range(40_000).select(F.lit(1).cast("long").alias("source_id"), F.lit(1).cast("long").alias("shot_id"), F.col("id").alias("frame"), (F.col("id") * 7919 % 1000).alias("cx"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [n for n in tracks.dead_zone(one, 60, span=1000).groupBy(F.spark_partition_id()).count().toPandas()["count"]]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 40_000 and max(sizes) < 25_000  # one shot in four tasks


def smoothed(values, window):
    window = min(max(1, window), len(values))
    window += window % 2 == 0
    if window > len(values):
        window = len(values) if len(values) % 2 else max(1, len(values) - 1)
    at = lambda i: values[min(max(i, 0), len(values) - 1)]
    return [(sum(at(i + k) for k in range(-(window // 2), window // 2 + 1)), window) for i in range(len(values))]


@pytest.mark.parametrize("window", [0, 1, 2, 5, 6, 31])
def test_smoothing_by_prefix_sums(spark, window):
    r = random.Random(window)
    rows = [(1, h, f, r.randrange(-500, 900)) for h in range(40) for f in range(3, 3 + h)]
    got = {(x["shot_id"], x["frame"]): (x["total"], x["width"]) for x in tracks.smooth(spark.createDataFrame(rows, TRACK).repartition(3), window).collect()}
    for (_, h), track in keyed(rows).items():
        assert [got[h, f] for f, _ in track] == smoothed([v for _, v in track], window)
    plan = tracks.smooth(spark.createDataFrame(rows, TRACK), 501)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 4  # whatever the window is


def naive(ranges, percent):
    kept, out = [], []
    for name, a, z in ranges:
        found = next((n for n, b, y in kept if 100 * max(0, min(y, z) - max(b, a)) >= percent * min(y - b, z - a)), None)
        out.append(found)
        if found is None:
            kept.append((name, a, z))
    return out


@pytest.mark.parametrize("percent", [0, 1, 30, 50, 75, 100, 150])
def test_index_of_kept_ranges(percent):
    r = random.Random(percent)
    for _ in range(60):
        wide = r.choice([5, 60, 2000])
        ranges = [(k, a, a + r.choice([1, 2, 7, r.randrange(1, wide)])) for k in range(r.randrange(1, 250)) for a in [r.randrange(wide * 3)]]
        index, got = Kept(percent), []
        for name, a, z in ranges:
            got.append(index.first(a, z))
            if got[-1] is None:
                index.add(name, a, z)
        assert got == naive(ranges, percent)


def test_large_island_is_quick(spark):
    r = random.Random(9)
    ranges = [(k, a, a + r.choice([3, 3, 40_000])) for k in range(100_000) for a in [r.randrange(500_000)]]
    began, index, lost = time.time(), Kept(50), 0
    for name, a, z in ranges:
        if index.first(a, z) is None:
            index.add(name, a, z)
        else:
            lost += 1
    assert time.time() - began < 20 and 0 < lost < 100_000
    n = 3000
    rows = [(1, k, str(k), a, z) for k, a, z in ranges[:n]]
    df = spark.createDataFrame(rows, "source_id long, position long, id string, start_frame long, end_frame long")
    got = {x["position"]: x["suppressor"] for x in ranking.suppress(df).collect()}
    assert [got[k] for k in range(n)] == [None if v is None else str(v) for v in naive(ranges[:n], 50)]
