"""The registered queries over per-frame records, crops, stages and small rules of layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.operators import media, runs, sequences, shots, tracks
from tidemark.plans.footage import _SAMPLED, _shots
from tidemark.plans.media import _WORDS
from tidemark.plans.registry import query
from tidemark.sources import tables

WIDTH, HEIGHT = 1920, 1080

_RECORDS = """
    be AS (SELECT user_id AS source_id, event_id AS e, event_type, value, (epoch_us(ts) - 1704067200000000) // 4800000000 AS frame FROM events),
    bs AS (SELECT *, frame // 240 AS shot_id, CAST(floor(value * 16) AS BIGINT) % 1700 AS x, e % 700 AS y FROM be QUALIFY row_number() OVER (PARTITION BY source_id, frame ORDER BY e) = 1),
    ba AS (SELECT source_id, shot_id, frame, {'f': frame, 'cx': (2 * x + 60 + e % 91) * 500, 'cy': (2 * y + 100 + e % 281) * 500, 'h': (100 + e % 281) * 1000, 'c': (e % 100) / 100.0::DOUBLE, 'd': ['yolo', 'hog', 'haar'][e % 3 + 1]} AS an FROM bs WHERE event_type <> 'error'),
    bt AS (SELECT source_id, max(frame) + 1 AS total FROM bs GROUP BY source_id),
    bf AS (SELECT source_id, frame // 240 AS shot_id, frame FROM (SELECT source_id, unnest(range(0, total)) AS frame FROM bt)),
    bw AS (SELECT bf.*, last_value(an IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p, first_value(an IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n,
                  last_value(an IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS z FROM bf LEFT JOIN ba USING (source_id, shot_id, frame) WINDOW w AS (PARTITION BY source_id, shot_id ORDER BY frame)),
    bl AS (SELECT *, CASE WHEN z IS NULL THEN 'none' WHEN p IS NULL THEN 'first' WHEN frame >= z.f THEN 'last' ELSE 'mid' END AS k, (frame - p.f) AS u, (n.f - p.f) AS v FROM bw),
    rec AS MATERIALIZED (SELECT source_id, shot_id, frame,
        CASE k WHEN 'none' THEN 960000 WHEN 'first' THEN n.cx WHEN 'last' THEN z.cx ELSE p.cx + CAST(trunc((n.cx - p.cx) * u / v) AS BIGINT) END AS cx,
        CASE k WHEN 'none' THEN 540000 WHEN 'first' THEN n.cy WHEN 'last' THEN z.cy ELSE p.cy + CAST(trunc((n.cy - p.cy) * u / v) AS BIGINT) END AS cy,
        CASE k WHEN 'none' THEN NULL WHEN 'first' THEN n.h WHEN 'last' THEN z.h ELSE p.h + CAST(trunc((n.h - p.h) * u / v) AS BIGINT) END AS box_height,
        CASE k WHEN 'none' THEN 0.0 WHEN 'first' THEN n.c WHEN 'last' THEN z.c ELSE least(p.c, n.c) END AS confidence,
        CASE k WHEN 'none' THEN 'center' WHEN 'first' THEN n.d WHEN 'last' THEN z.d ELSE p.d END AS detector FROM bl)"""


def _records(spark, sf_dir, by_shot=False):
    return tracks.frame_records(tables.track_shots(spark, sf_dir), tables.boxes(spark, sf_dir), WIDTH, HEIGHT, by_shot)


def _stretches(spark, sf_dir):
    return tracks.record_stretches(tables.track_shots(spark, sf_dir), tables.boxes(spark, sf_dir))


@query("frame_records", f"""WITH {_RECORDS} SELECT source_id, shot_id, frame, cx, cy, (cx - box_height * 0.25) / 1000.0 AS box_left, (cy + box_height * 0.5) / 1000.0 AS box_bottom, confidence,
    CASE WHEN confidence > 0 THEN '' ELSE 'no-detection' END AS flags, detector FROM rec""")
def frame_records(spark, sf_dir):
    """A record for every frame of every shot, both axes; a box is half as wide as it is high."""
    own = _records(spark, sf_dir)
    box = lambda c, share: (F.col(c) + F.col("box_height") * share) / 1000.0
    return own.select("source_id", "shot_id", "frame", "cx", "cy", box("cx", -0.25).alias("box_left"), box("cy", 0.5).alias("box_bottom"), "confidence", F.array_join("flags", ",").alias("flags"), "detector")


_WEAK = f"""{_RECORDS}, w AS (SELECT source_id, frame, confidence < 0.3 AS weak, lead(frame) OVER o AS following, row_number() OVER o AS i FROM rec WINDOW o AS (PARTITION BY source_id ORDER BY frame)),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY source_id, weak ORDER BY frame) AS run FROM w),
    r AS (SELECT source_id, min(frame) AS start_frame, max(coalesce(following, frame + 1)) AS end_frame FROM g WHERE weak GROUP BY source_id, run)"""


@query("weak_ranges", f"WITH {_WEAK} SELECT * FROM r")
def weak_ranges(spark, sf_dir):
    """Runs of frames without enough confidence, or with a flag."""
    return tracks.weak_ranges(_stretches(spark, sf_dir), 0.3)


@query("reviewed_ranges", f"""WITH {_WEAK} SELECT *, CASE WHEN end_frame - start_frame <= 5 THEN 'accepted' ELSE 'unresolved' END AS state, CASE WHEN end_frame - start_frame <= 5 THEN 'dev' END AS accepted_by,
    CASE WHEN end_frame - start_frame <= 5 THEN 'short' END AS note FROM r""")
def reviewed_ranges(spark, sf_dir):
    """Weak ranges, with the reviewer of those that are accepted."""
    return runs.accepted(weak_ranges(spark, sf_dir), "dev", "short", F.col("end_frame") - F.col("start_frame") <= 5)


_CROPPED = f"""{_RECORDS},
    ci AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY source_id, shot_id) AS n FROM rec WINDOW w AS (PARTITION BY source_id, shot_id ORDER BY frame)),
    cm AS (SELECT source_id, shot_id, CAST(floor(coalesce(median(greatest(box_height, 1000)), 486000.0)) AS BIGINT) AS wanted FROM rec GROUP BY ALL),
    cz AS MATERIALIZED (SELECT ci.*, CASE WHEN box_height IS NULL THEN 1000000 ELSE least(greatest(1000000 * wanted // greatest(box_height, 1000), 1000000), 1250000) END AS z,
           CASE WHEN n >= 11 THEN 11 WHEN n % 2 = 1 THEN n ELSE greatest(1, n - 1) END AS w1, CASE WHEN n >= 31 THEN 31 WHEN n % 2 = 1 THEN n ELSE greatest(1, n - 1) END AS w2 FROM ci JOIN cm USING (source_id, shot_id)),
    sm AS MATERIALIZED (SELECT a.source_id, a.shot_id, a.i, any_value(a.frame) AS frame, any_value(a.confidence) AS confidence, trunc(sum(b.cx) FILTER (2 * abs(k) < a.w1) / any_value(a.w1)) AS x, trunc(sum(b.cy) FILTER (2 * abs(k) < a.w1) / any_value(a.w1)) AS y,
                               trunc(sum(b.z) FILTER (2 * abs(k) < a.w2) / any_value(a.w2)) AS z
           FROM cz a, (SELECT unnest(range(-15, 16)) AS k), cz b WHERE 2 * abs(k) < a.w2 AND b.source_id = a.source_id AND b.shot_id = a.shot_id AND b.i = greatest(1, least(a.n, a.i + k)) GROUP BY ALL),
    mo(source_id, shot_id, i, hx, hy, x, y, z, dx, dy, dz) AS (
        SELECT source_id, shot_id, i, CAST(x * 1000 AS BIGINT), CAST(y * 1000 AS BIGINT), CAST(x * 1000 AS BIGINT), CAST(y * 1000 AS BIGINT), CAST(z * 1000 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM sm WHERE i = 1
        UNION ALL SELECT source_id, shot_id, i, hx, hy, x + vx, y + vy, z + vz, vx, vy, vz FROM (
            SELECT source_id, shot_id, i, hx, hy, x, y, z, least(greatest(dx + least(greatest(least(greatest(hx - x, -43333333), 43333333) - dx, -5777777), 5777777), -43333333), 43333333) AS vx,
                   least(greatest(dy + least(greatest(least(greatest(hy - y, -43333333), 43333333) - dy, -5777777), 5777777), -43333333), 43333333) AS vy, least(greatest(dz + least(greatest(least(greatest(tz - z, -4000000), 4000000) - dz, -555555), 555555), -4000000), 4000000) AS vz
            FROM (SELECT sm.source_id, sm.shot_id, sm.i, CAST(least(greatest(mo.hx, (sm.x - 45000) * 1000), (sm.x + 45000) * 1000) AS BIGINT) AS hx, CAST(least(greatest(mo.hy, (sm.y - 22500) * 1000), (sm.y + 22500) * 1000) AS BIGINT) AS hy, mo.x, mo.y, mo.z, CAST(sm.z * 1000 AS BIGINT) AS tz, mo.dx, mo.dy, mo.dz
                  FROM mo JOIN sm ON sm.source_id = mo.source_id AND sm.shot_id = mo.shot_id AND sm.i = mo.i + 1))),
    cs AS (SELECT sm.source_id, sm.shot_id, sm.frame, sm.confidence, mo.x // 1000 AS x, mo.y // 1000 AS y, least(greatest(mo.z // 1000, 1000000), 1250000) AS zoom FROM mo JOIN sm USING (source_id, shot_id, i)),
    ch AS (SELECT *, 607500000000 // zoom AS width, 1080000000000 // zoom AS height FROM cs),
    crops AS MATERIALIZED (SELECT source_id, shot_id, frame, CAST(least(greatest(CAST(trunc(x - width // 2) AS BIGINT), 0), 1920000 - width) AS BIGINT) AS x, CAST(least(greatest(y - height * 4 // 100 - height // 2, 0), 1080000 - height) AS BIGINT) AS y, width, height, zoom, confidence FROM ch)"""


def _crops(spark, sf_dir, *rest):
    """Crops with `rest`, what else of the records is asked for: it would go through every sort and fold."""
    records = _records(spark, sf_dir, by_shot=True).select("source_id", "shot_id", "frame", "cx", "cy", "box_height", *rest)
    return tracks.crop_frames(records, WIDTH, HEIGHT, 9, 16, zoom=(1.0, 1.25))


@query("crop_frames", f"WITH RECURSIVE {_CROPPED} SELECT * FROM crops")
def crop_frames(spark, sf_dir):
    """The crop of every frame: both axes and zoom smoothed, held and limited, inside the source."""
    return _crops(spark, sf_dir, "confidence")


@query("crop_lines", f"""WITH RECURSIVE {_CROPPED} SELECT source_id, frame, printf('%.9f crop w %d.%03d, crop h %d.%03d, crop x %d.%03d, crop y %d.%03d;', frame / 30.0::DOUBLE,
    width // 1000, width % 1000, height // 1000, height % 1000, x // 1000, x % 1000, y // 1000, y % 1000) AS line FROM crops""")
def crop_lines(spark, sf_dir):
    return tracks.crop_lines(_crops(spark, sf_dir), 30)


@query("canvas_transforms", f"""WITH RECURSIVE {_CROPPED} SELECT source_id, frame, sx AS scale, -(x / 1000.0::DOUBLE) * sx AS dx, -(y / 1000.0::DOUBLE) * sy AS dy, CASE WHEN abs(sx - sy) > 0.001 THEN 'Crop aspect does not match the canvas' END AS error
    FROM (SELECT *, 1080.0::DOUBLE / (width / 1000.0::DOUBLE) AS sx, 1921.0::DOUBLE / (height / 1000.0::DOUBLE) AS sy FROM crops)""")
def canvas_transforms(spark, sf_dir):
    """Crops on a canvas one line too high, so that those of larger scale don't fit it."""
    return tracks.canvas_transforms(_crops(spark, sf_dir), 1080, 1921)


@query("still_crops", f"""WITH RECURSIVE {_CROPPED}, st AS (SELECT source_id, shot_id, min(frame) AS a, max(frame) + 1 AS z FROM rec GROUP BY ALL),
    ro AS (SELECT source_id, shot_id, unnest([{{'r': 'first', 'f': a}}, {{'r': 'middle', 'f': a + (z - a - 1) // 2}}, {{'r': 'last', 'f': z - 1}}]) AS r FROM st)
    SELECT ro.source_id, ro.shot_id, r.r AS role, r.f AS frame, x, y, width, height FROM ro JOIN crops c ON c.source_id = ro.source_id AND c.frame = r.f""")
def still_crops(spark, sf_dir):
    """The first, middle and last frame of every shot with their crops."""
    return shots.still_crops(shots.stills(tables.track_shots(spark, sf_dir)), _crops(spark, sf_dir).select("source_id", "frame", "x", "y", "width", "height"))


@query("sampled_detections", f"""WITH RECURSIVE {_SAMPLED} SELECT a.source_id, a.frame, b.confidence FROM sampled a
    LEFT JOIN (SELECT user_id AS source_id, event_id % 4000 * 500 AS frame, max(event_id % 100) AS confidence FROM events GROUP BY ALL) b USING (source_id, frame)""")
def sampled_detections(spark, sf_dir):
    """Sampled frames with what was found there, if anything was."""
    found = tables.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("source_id"), (F.col("event_id") % 4000 * 500).alias("frame")).agg(F.max(F.col("event_id") % 100).alias("confidence"))
    return shots.sampled_detections(shots.sample_frames(tables.totals(spark, sf_dir), _shots(spark, sf_dir), 500), found)


@query("static_records", """SELECT source_id, 'shot-001' AS shot_id, unnest(range(0, total)) AS frame, 960000 AS cx, 540000 AS cy, 1.0::DOUBLE AS confidence, 'static' AS detector
    FROM (SELECT p_partkey AS source_id, p_partkey % 40 AS total FROM part)""")
def static_records(spark, sf_dir):
    own = tables.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source_id"), (F.col("p_partkey") % 40).alias("total"))
    return tracks.static_records(own, WIDTH * 500, HEIGHT * 500).drop("box_height", "flags")


@query("imported_manifests", f"""WITH RECURSIVE {_CROPPED}, v AS (SELECT source_id, count(*) + source_id % 2 AS total FROM crops GROUP BY source_id)
    SELECT source_id, source_id % 2 = 0 AS passed, CASE WHEN source_id % 2 = 0 THEN '' ELSE 'expected ' || total || ' records, found ' || total - 1 END AS errors, 'external' AS tier, CASE WHEN source_id % 2 = 0 THEN 'review-pending' ELSE 'failed' END AS status FROM v""")
def imported_manifests(spark, sf_dir):
    """Foreign crops are validated; the state follows from that alone."""
    videos = tables.track_shots(spark, sf_dir).groupBy("source_id").agg(F.max("end_frame").alias("n")).select("source_id", (F.col("n") + F.col("source_id") % 2).alias("total"))
    pixels = _crops(spark, sf_dir).select("source_id", "frame", *((F.col(c) / 1000.0).alias(c) for c in ("x", "y", "width", "height")))
    return runs.imported(tracks.track_errors(pixels, videos, 9, 16, WIDTH, HEIGHT))


@query("active_tokens", f"""WITH {_WORDS}, f AS (SELECT source_id, unnest(range(0, m * 30 // 1000 + 40, 40)) AS frame FROM (SELECT source_id, max(end_ms) AS m FROM words GROUP BY source_id))
    SELECT f.source_id, f.frame, idx FROM f JOIN words w ON w.source_id = f.source_id AND start_ms * 30 <= frame * 1000 AND end_ms * 30 > frame * 1000""")
def active_tokens(spark, sf_dir):
    """The words that are spoken at every fortieth frame."""
    return sequences.active_tokens(tables.words(spark, sf_dir), 30, 40)


@query("run_stages", f"""WITH s AS (SELECT unnest(range(0, 11)) AS position), n AS (SELECT {list(runs.STAGES)!r} AS names)
    SELECT run_id, names[position + 1] AS stage, CAST(position AS INTEGER) AS position, CASE WHEN position IN (0, 4) THEN 'complete' ELSE 'pending' END AS status, CASE WHEN position = 4 THEN c END AS n_clips
    FROM (SELECT l_orderkey AS run_id, count(*) AS c FROM lineitem GROUP BY l_orderkey), s, n""")
def run_stages(spark, sf_dir):
    return runs.run_stages(tables.manifest(spark, sf_dir))


@query("source_notes", """SELECT p_partkey AS media_id, CASE WHEN h > w THEN 'vertical' WHEN w > h THEN 'horizontal' ELSE 'square' END AS orientation, w >= h AS needs_reframing, greatest(1, CAST(round_even(m * 0.15::DOUBLE, 0) AS BIGINT)) AS least_minutes, greatest(2, CAST(round_even(m * 0.25::DOUBLE, 0) AS BIGINT)) AS most_minutes
    FROM (SELECT p_partkey, [1080, 720, 1920, 1000][p_partkey % 4 + 1] AS w, [1920, 1280, 1080, 1000][p_partkey % 4 + 1] AS h, p_partkey * 7 % 1200 / 10.0::DOUBLE AS m FROM part)""")
def source_notes(spark, sf_dir):
    """How a source lies, whether it needs reframing, and how long a transcript takes."""
    k = F.col("p_partkey")
    pick = lambda *v: F.get(F.array(*map(F.lit, v)), (k % 4).cast("int"))
    own = tables.table(spark, sf_dir, "part").select(k.alias("media_id"), pick(1080, 720, 1920, 1000).alias("w"), pick(1920, 1280, 1080, 1000).alias("h"), (k * 7 % 1200 / F.lit(10.0)).alias("m"))
    estimate = scalar.minutes_estimate(F.col("m"))
    return own.select("media_id", scalar.orientation(F.col("w"), F.col("h")).alias("orientation"), (F.col("w") >= F.col("h")).alias("needs_reframing"), estimate["least"].alias("least_minutes"), estimate["most"].alias("most_minutes"))


_SIZES = {"hook_top": 300, "hook_size": 78, "hook_sub_size": 40, "caption_bottom": 300, "caption_size": 70, "cue_size": 52}


@query("type_sizes", "SELECT p_partkey AS media_id, " + ", ".join(f"CAST(round_even({v}.0::DOUBLE * ((p_partkey * 13 % 2400 + 240) / 1920.0::DOUBLE), 0) AS BIGINT) AS {n}" for n, v in _SIZES.items()) + " FROM part")
def type_sizes(spark, sf_dir):
    """Sizes drawn for a canvas of 1920 lines, on canvases of other heights."""
    height = (F.col("p_partkey") * 13 % 2400 + 240).cast("double")
    return tables.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("media_id"), *(scalar.scaled(v, height).alias(n) for n, v in _SIZES.items()))


@query("hook_opacity", """SELECT event_id, CASE WHEN hold > 20 THEN CASE WHEN f <= 0 THEN 0.0 WHEN f < 8 THEN f / 8.0::DOUBLE WHEN f <= hold - 12 THEN 1.0 WHEN f < hold THEN (hold - f) / 12.0::DOUBLE ELSE 0.0 END END AS opacity
    FROM (SELECT event_id, event_id % 90 - 4 AS f, event_id * 7 % 76 AS hold FROM events)""")
def hook_opacity(spark, sf_dir):
    e = F.col("event_id")
    return tables.table(spark, sf_dir, "events").select(e, scalar.hook_opacity((e % 90 - 4).cast("double"), (e * 7 % 76).cast("double")).alias("opacity"))


@query("framing_errors", """SELECT media_id, CASE WHEN w <= 0 OR h <= 0 THEN 'output dimensions must be positive' WHEN a < 1 THEN 'min_zoom must be at least 1.0' WHEN z < a THEN 'max_zoom must be greater than or equal to min_zoom' WHEN s <= 0 THEN 'target_subject_height must be positive' END AS error
    FROM (SELECT p_partkey AS media_id, p_partkey % 11 * 100 AS w, p_partkey % 13 * 100 AS h, (8 + p_partkey % 5) / 10.0::DOUBLE AS a, (10 + p_partkey % 3) / 10.0::DOUBLE AS z, CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 7 END AS s FROM part)""")
def framing_errors(spark, sf_dir):
    """The first thing wrong with settings for a crop."""
    k = F.col("p_partkey")
    tenths = lambda base, v: (F.lit(base) + v) / F.lit(10.0)
    error = scalar.framing_errors(k % 11 * 100, k % 13 * 100, tenths(8, k % 5), tenths(10, k % 3), F.when(k % 2 == 0, k % 7))
    return tables.table(spark, sf_dir, "part").select(k.alias("media_id"), error.alias("error"))


@query("heaviest_boxes", """WITH b AS (SELECT user_id AS source_id, event_id, event_id % 100 AS x0, event_id % 70 AS y0, event_id % 100 + event_id % 9 AS x1, event_id % 70 + event_id % 11 AS y1, event_id % 37 / 16.0::DOUBLE - 0.5 AS weight FROM events)
    SELECT source_id, event_id, x0, y0, x1, y1, least(1.0, greatest(0.0, weight / 2.0::DOUBLE)) AS confidence FROM b QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY weight DESC, event_id) = 1""")
def heaviest_boxes(spark, sf_dir):
    e = F.col("event_id")
    own = tables.table(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), e, (e % 100).alias("x0"), (e % 70).alias("y0"), (e % 100 + e % 9).alias("x1"), (e % 70 + e % 11).alias("y1"), (e % 37 / F.lit(16.0) - 0.5).alias("weight"))
    return media.heaviest(own, "source_id", "weight", "event_id")


@query("centre_boxes", """SELECT p_partkey AS media_id, w * 0.3::DOUBLE AS x0, 0.0::DOUBLE AS y0, w * 0.7::DOUBLE AS x1, CAST(h AS DOUBLE) AS y1, 0.0::DOUBLE AS confidence, 'center' AS detector FROM (SELECT p_partkey, p_partkey % 1900 + 20 AS w, p_partkey % 1000 + 80 AS h FROM part)""")
def centre_boxes(spark, sf_dir):
    k = F.col("p_partkey")
    return tables.table(spark, sf_dir, "part").select(k.alias("media_id"), media.centre_box(k % 1900 + 20, k % 1000 + 80).alias("b")).select("media_id", "b.*")
