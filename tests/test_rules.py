"""Golden cases of the library's rules, on small literal inputs."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranking, runs, sequences, shots, tracks
from tidemark.sources import documents

CANDIDATE = "source_id string, event_id long, id string, fps double, start_frame long, end_frame long, topic_key string, flags array<string>, hook decimal(9,4), self_contained decimal(9,4), emotion decimal(9,4), payoff decimal(9,4), retention decimal(9,4)"


def candidate(n, start, end, hook="8", topic="t", id_="", fps=30.0, flags=(), **scores):
    from decimal import Decimal

    values = {"self_contained": "8", "emotion": "8", "payoff": "8", "retention": "8", "hook": hook} | scores
    decimal = {k: None if v is None else Decimal(v) for k, v in values.items()}
    return ("s", n, id_, fps, start, end, topic, list(flags), *(decimal[c] for c in ("hook", "self_contained", "emotion", "payoff", "retention")))


def ranked(spark, rows, **settings):
    out = ranking.in_order(ranking.rank(spark.createDataFrame(rows, CANDIDATE), **settings)).collect()
    return {r["event_id"]: r for r in out}, [r["event_id"] for r in out]


def test_reasons_to_reject(spark):
    rows = [
        candidate(1, 0, 900, "10", self_contained="9", emotion="7", payoff="9", retention="5"), candidate(2, 1000, 1900, None), candidate(3, 2000, 2900, emotion=None), candidate(4, 3000, 3900, "11", topic=" \n"),
        candidate(5, 4000, 4900, flags=["missingPayoff", "other", "midSentence"]), candidate(6, 5000, 5000), candidate(7, None, 6000), candidate(8, 10000, 12400, fps=60.0), candidate(9, 20000, 20300), candidate(10, 30000, 40000, "-1"),
    ]
    got, _ = ranked(spark, rows)
    assert float(got[1]["composite"]) == 8.4 and got[1]["rank"] == 1
    assert {n: r["reasons"] for n, r in got.items() if r["status"] == "rejected"} == {
        2: "score hook is missing", 3: "score emotion is missing", 4: "score hook must be between 0 and 10; topicKey is required", 5: "blocking flags: midSentence, missingPayoff",
        6: "invalid half-open frame range", 7: "invalid half-open frame range", 9: "below minimum duration", 10: "above maximum duration; score hook must be between 0 and 10",
    }
    assert got[8]["status"] == "selected"  # 40 s at its own rate
    assert all(r["composite"] is None for n, r in got.items() if n not in (1, 8))


def test_suppression_diversity_and_order(spark):
    rows = [candidate(1, 0, 1800, "9"), candidate(2, 600, 2400, "7", id_="mine"), candidate(3, 3000, 4000, "10", "a", "x"), candidate(4, 5000, 6000, "9.5", "a"), candidate(5, 7000, 8000, "6", "b"), candidate(6, 9000, 10000, "5", "c")]
    got, order = ranked(spark, rows, count=4)
    assert got[2]["reasons"] == f"overlaps {got[1]['id']}" and got[2]["id"] == "mine" and got[3]["id"] == "x" and len(got[1]["id"]) == 12
    assert [n for n in order if got[n]["rank"]] == [3, 1, 5, 6] and got[4]["reasons"] == "outside requested count" and order[4:] == [2, 4]
    got, order = ranked(spark, rows, count=5)
    assert order[:5] == [3, 1, 5, 6, 4]  # repeated topics fill what is left
    _, order = ranked(spark, rows, count=3, diverse=False)
    assert order[:3] == [3, 4, 1]


def test_documents_are_ranked(spark, tmp_path):
    scores = {"hook": 9, "selfContainedness": 7, "emotion": 4, "payoffDensity": 6, "retention": 2}
    good = {"id": "", "startFrame": 0, "endFrameExclusive": 900, "topicKey": "t", "scores": scores, "rejectionFlags": None}
    (tmp_path / "c.json").write_text(json.dumps({"candidates": [good, good | {"startFrame": 2000, "endFrameExclusive": 2900, "scores": {"hook": 1}}]}))
    out = {r["event_id"]: r for r in ranking.rank(documents.ranking_input(documents.read_candidates(spark, str(tmp_path)), 30)).collect()}
    assert float(out[0]["composite"]) == 6.2 and out[1]["reasons"] == "score selfContainedness is missing"


SHOTS, SAMPLES = "source_id long, shot_id string, start_frame long, end_frame long", "source_id long, shot_id string, frame long, x0 double, y0 double, x1 double, y1 double, confidence double, detector string"


def records(spark, shot_rows, sample_rows, width=640, height=360):
    out = tracks.frame_records(spark.createDataFrame(shot_rows, SHOTS), spark.createDataFrame(sample_rows, SAMPLES), width, height)
    return out, {(r["shot_id"], r["frame"]): r for r in out.collect()}


def box(shot, frame, cx, confidence=0.9, detector="d"):
    return (1, shot, frame, cx - 10.0, 100.0, cx + 10.0, 140.0, confidence, detector)


def test_frame_records(spark):
    none = (1, "c", 4, None, None, None, None, None, None)
    _, got = records(spark, [(1, "a", 0, 11), (1, "b", 11, 14), (1, "c", 14, 17), (1, "empty", 20, 20)], [box("a", 0, 50), box("a", 5, 150, 0.3, "e"), box("a", 10, 350), box("b", 12, 550, 0.0), none])
    assert len(got) == 17
    assert [got["a", f]["cx"] for f in (0, 2, 5, 7, 10)] == [50_000, 90_000, 150_000, 230_000, 350_000] and got["a", 3]["box_height"] == 40_000 and got["a", 3]["cy"] == 120_000
    assert (got["a", 5]["confidence"], got["a", 5]["detector"]) == (0.3, "d") and got["a", 10]["confidence"] == 0.9
    assert {(got["b", f]["cx"], *got["b", f]["flags"]) for f in (11, 12, 13)} == {(550_000, "no-detection")}  # nothing drifts across a cut
    assert {(r["cx"], r["cy"], r["box_height"], r["confidence"], r["detector"]) for (s, _), r in got.items() if s == "c"} == {(320_000, 180_000, None, 0.0, "center")}


def test_weak_ranges(spark):
    rows = [(1, 0, 0.9, []), (1, 1, 0.1, []), (1, 2, 0.9, ["x"]), (1, 3, 0.9, []), (2, 0, 0.9, None), (2, 1, 0.1, [])]
    got = tracks.weak_ranges(spark.createDataFrame(rows, "source_id long, frame long, confidence double, flags array<string>"), 0.3)
    assert sorted(map(tuple, got.collect())) == [(1, 1, 3), (2, 1, 2)]


def smoothed(values, window):
    """Mean over a centred window, ends repeated, as floats."""
    window = min(window, len(values))
    window += window % 2 == 0
    if window > len(values):
        window = len(values) if len(values) % 2 else max(1, len(values) - 1)
    r = window // 2
    at = lambda i: values[min(max(i, 0), len(values) - 1)]
    return [sum(at(i + k) for k in range(-r, r + 1)) / window for i in range(len(values))]


def followed(values, velocity, acceleration):
    out, speed = values[:1], 0.0
    clip = lambda v, m: min(max(v, -m), m)
    for v in values[1:]:
        speed = clip(speed + clip(clip(v - out[-1], velocity) - speed, acceleration), velocity)
        out.append(out[-1] + speed)
    return out


def held(values, radius):
    out = values[:1]
    for v in values[1:]:
        out.append(min(max(out[-1], v - radius), v + radius))
    return out


@pytest.mark.parametrize("length", [1, 2, 4, 9, 60])
def test_crops_are_those_of_plain_folds(spark, length):
    r = random.Random(length)
    own, got = records(spark, [(1, "a", 0, length)], [box("a", f, r.randrange(20, 620)) for f in range(0, length, 5)])
    rows = [got["a", f] for f in range(length)]
    crops = {c["frame"]: c for c in tracks.crop_frames(own, 640, 360, 9, 16, zoom=(1.0, 1.5), subject_height=60).collect()}
    x, y = ([v / 1000 for v in smoothed([row[c] for row in rows], 10)] for c in ("cx", "cy"))
    x, y = followed(held(x, 45), 1300 / 30, 5200 / 900), followed(held(y, 22.5), 1300 / 30, 5200 / 900)
    z = followed(smoothed([min(max(60_000 / row["box_height"], 1), 1.5) for row in rows], 30), 0.12 / 30, 0.5 / 900)
    for f in range(length):
        w, h = 202.5 / z[f], 360 / z[f]
        want = (min(max(x[f] - w / 2, 0), 640 - w), min(max(y[f] - h * 0.04 - h / 2, 0), 360 - h), w, h)
        assert all(abs(crops[f][c] / 1000 - v) < 0.3 for c, v in zip(("x", "y", "width", "height"), want))
    errors = tracks.track_errors(tracks.crop_frames(own, 640, 360, 9, 16).select("source_id", "frame", *((F.col(c) / 1000.0).alias(c) for c in ("x", "y", "width", "height"))), spark.createDataFrame([(1, 640, 360, length)], "source_id long, w int, h int, total long"), 9, 16)
    assert runs.imported(errors).first()["status"] == "review-pending"


def test_settings_of_crops(spark):
    own, _ = records(spark, [(1, "a", 0, 2)], [])
    for settings in ({"zoom": (0.5, 1.0)}, {"zoom": (1.2, 1.1)}, {"zoom": (1.0, 1.1), "subject_height": 0}):
        with pytest.raises(ValueError, match="zoom|subject"):
            tracks.crop_frames(own, 640, 360, 9, 16, **settings)
    with pytest.raises(ValueError, match="dimensions"):
        tracks.crop_frames(own, 640, 360, 0, 16)


def test_shots_between_cuts(spark):
    cuts = spark.createDataFrame([(1, 37), (1, 141), (2, 3), (2, 5), (2, 9), (3, 12), (3, 20), (3, 95)], "source_id long, frame long")
    totals = spark.createDataFrame([(1, 230), (2, 90), (3, 100), (4, 0)], "source_id long, total long")
    got = sorted((r["source_id"], r["start_frame"], r["end_frame"]) for r in shots.build_shots(cuts, totals).collect())
    assert got == [(1, 0, 37), (1, 37, 141), (1, 141, 230), (2, 0, 90), (3, 0, 12), (3, 12, 100)]


def test_word_errors(spark):
    rows = [(1, 0, "a", 1000, 2000), (1, 1, " \t", 500, 2500), (1, 2, "c", None, 3000), (1, 3, "d", 2400, 2400), (1, 4, "e", 9000, 9900)]
    words = spark.createDataFrame(rows, "source_id long, idx long, word string, start_ms long, end_ms long")
    got = sorted((r["idx"], r["error"]) for r in sequences.word_errors(words, F.lit(9000)).collect())
    assert got == [(1, "blank word"), (1, "not monotonic"), (2, "times must be finite"), (3, "invalid range"), (3, "not monotonic"), (4, "beyond the source")]
