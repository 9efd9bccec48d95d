"""The registered queries over scene logs, shots, trajectories and captions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import overlap
from tidemark.operators import media, sequences, shots, tracks
from tidemark.plans.media import _TRACK, _WORDS, _segments
from tidemark.plans.registry import query
from tidemark.sources import tables

_CUTS = r"""
    ev AS (SELECT user_id AS source_id, event_id, event_type, (epoch_us(ts) - 1704067200000000) // 1000000 AS ms FROM events),
    al AS (SELECT *, lag(CASE WHEN event_type = 'view' AND event_id % 50 <> 0 THEN ms END) OVER (PARTITION BY source_id ORDER BY event_id) AS armed FROM ev WHERE event_type IN ('view', 'click')),
    cuts AS MATERIALIZED (SELECT DISTINCT source_id, armed * 25 // 1000 + CAST(armed * 25 % 1000 > 500 OR (armed * 25 % 1000 = 500 AND armed * 25 // 1000 % 2 = 1) AS BIGINT) AS frame
             FROM al WHERE event_type = 'click' AND armed IS NOT NULL AND armed * 25 > 500),
    totals AS (SELECT source_id, max(ms * 25 // 1000) - 40 AS total FROM ev GROUP BY source_id HAVING max(ms * 25 // 1000) > 40)
"""

_SHOTS = f"""{_CUTS},
    oc AS MATERIALIZED (SELECT c.source_id, c.frame, row_number() OVER (PARTITION BY c.source_id ORDER BY c.frame) AS k FROM cuts c JOIN totals t USING (source_id) WHERE c.frame < t.total),
    fo(source_id, k, held, took) AS (
        SELECT source_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), false FROM totals
        UNION ALL SELECT oc.source_id, oc.k, CASE WHEN oc.frame - fo.held >= 12 THEN oc.frame ELSE fo.held END, oc.frame - fo.held >= 12 FROM fo JOIN oc ON oc.source_id = fo.source_id AND oc.k = fo.k + 1),
    pts AS (SELECT source_id, CAST(0 AS BIGINT) AS p FROM totals UNION ALL
            SELECT source_id, held FROM (SELECT fo.*, total, row_number() OVER (PARTITION BY source_id ORDER BY k DESC) AS b FROM fo JOIN totals USING (source_id) WHERE took) WHERE b > 1 OR total - held >= 12),
    shots AS MATERIALIZED (SELECT source_id, printf('shot-%03d', CAST(row_number() OVER w AS INTEGER)) AS shot_id, p AS start_frame, coalesce(lead(p) OVER w, total) AS end_frame FROM pts JOIN totals USING (source_id) WINDOW w AS (PARTITION BY source_id ORDER BY p))
"""

_SAMPLED = f"""{_SHOTS},
    sampled AS (SELECT source_id, unnest(range(0, total, 500)) AS frame FROM totals UNION SELECT source_id, total - 1 FROM totals UNION SELECT source_id, start_frame FROM shots)"""


def _shots(spark, sf_dir):
    return shots.build_shots(shots.cuts_from_log(tables.log_lines(spark, sf_dir), 25), tables.totals(spark, sf_dir))


@query("scene_cuts", f"WITH {_CUTS} SELECT source_id, frame FROM cuts")
def scene_cuts(spark, sf_dir):
    return shots.cuts_from_log(tables.log_lines(spark, sf_dir), 25)


@query("shots", f"WITH RECURSIVE {_SHOTS} SELECT * FROM shots")
def shot_table(spark, sf_dir):
    return _shots(spark, sf_dir)


@query("sample_frames", f"WITH RECURSIVE {_SAMPLED} SELECT source_id, frame FROM sampled")
def sample_frames(spark, sf_dir):
    return shots.sample_frames(tables.totals(spark, sf_dir), _shots(spark, sf_dir), 500)


@query("frames_in_shots", f"""WITH RECURSIVE {_SAMPLED} SELECT a.source_id, a.frame, coalesce(s.shot_id, 'shot-001') AS shot_id
    FROM sampled a LEFT JOIN shots s ON s.source_id = a.source_id AND a.frame >= s.start_frame AND a.frame < s.end_frame""")
def frames_in_shots(spark, sf_dir):
    found = _shots(spark, sf_dir)
    return shots.place_frames(shots.sample_frames(tables.totals(spark, sf_dir), found, 500), found)


@query("shot_stills", f"""WITH RECURSIVE {_SHOTS} SELECT source_id, shot_id, r.role, r.frame FROM (SELECT source_id, shot_id, unnest([{{'role': 'first', 'frame': start_frame}},
    {{'role': 'middle', 'frame': start_frame + (end_frame - start_frame - 1) // 2}}, {{'role': 'last', 'frame': end_frame - 1}}]) AS r FROM shots)""")
def shot_stills(spark, sf_dir):
    return shots.stills(_shots(spark, sf_dir))


_FILLED = f"""{_TRACK},
    fn AS (SELECT source_id, shot_id, frame, cx, row_number() OVER (PARTITION BY source_id, shot_id ORDER BY frame) AS i FROM s),
    fk AS (SELECT *, CASE WHEN cx IS NOT NULL THEN {{'i': i, 'x': cx}} END AS k FROM fn),
    fb AS (SELECT *, last_value(k IGNORE NULLS) OVER (PARTITION BY source_id, shot_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l,
                  first_value(k IGNORE NULLS) OVER (PARTITION BY source_id, shot_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r FROM fk),
    filled AS MATERIALIZED (SELECT source_id, shot_id, frame, i, CAST(CASE WHEN l IS NULL AND r IS NULL THEN 960000 WHEN l IS NULL THEN r.x * 1000 WHEN r IS NULL OR l.i = r.i THEN l.x * 1000
               ELSE l.x * 1000 + CAST(trunc(((r.x - l.x) * 1000 * (i - l.i)) / (r.i - l.i)) AS BIGINT) END AS BIGINT) AS cx FROM fb)"""

_CROPS = f"""{_FILLED},
    hn AS (SELECT source_id, shot_id, max(i) AS n FROM filled GROUP BY ALL),
    ho AS (SELECT f.source_id, f.shot_id, f.frame, f.i, greatest(1, least(hn.n, f.i + k)) AS at FROM filled f JOIN hn USING (source_id, shot_id), (SELECT unnest([-2, -1, 0, 1, 2]) AS k) WHERE 2 * abs(k) < CASE WHEN n >= 5 THEN 5 WHEN n >= 3 THEN 3 ELSE 1 END),
    sm AS MATERIALIZED (SELECT o.source_id, o.shot_id, o.frame, o.i, CAST(sum(f.cx) AS BIGINT) // count(*) AS v FROM ho o JOIN filled f ON f.source_id = o.source_id AND f.shot_id = o.shot_id AND f.i = o.at GROUP BY ALL),
    dz(source_id, shot_id, i, frame, o) AS (
        SELECT source_id, shot_id, i, frame, v FROM sm WHERE i = 1
        UNION ALL SELECT sm.source_id, sm.shot_id, sm.i, sm.frame, least(greatest(dz.o, sm.v - 20000), sm.v + 20000) FROM dz JOIN sm ON sm.source_id = dz.source_id AND sm.shot_id = dz.shot_id AND sm.i = dz.i + 1),
    lm(source_id, shot_id, i, frame, o, d) AS (
        SELECT source_id, shot_id, i, frame, o, CAST(0 AS BIGINT) FROM dz WHERE i = 1
        UNION ALL SELECT source_id, shot_id, i, frame, o + w, w FROM (
            SELECT dz.source_id, dz.shot_id, dz.i, dz.frame, lm.o AS o, least(greatest(lm.d + least(greatest(least(greatest(dz.o - lm.o, -60000), 60000) - lm.d, -25000), 25000), -60000), 60000) AS w
            FROM lm JOIN dz ON dz.source_id = lm.source_id AND dz.shot_id = lm.shot_id AND dz.i = lm.i + 1)),
    crops AS (SELECT source_id, shot_id, frame, o AS cx, least(greatest(o - 608 * 500, 0), (1920 - 608) * 1000) AS x FROM lm)"""


def _samples(spark, sf_dir):
    return tables.detections(spark, sf_dir).select("source_id", "shot_id", "frame", "cx")


@query("fill_track", f"WITH {_FILLED} SELECT source_id, shot_id, frame, cx FROM filled")
def fill_track(spark, sf_dir):
    return tracks.fill(_samples(spark, sf_dir), 960)


@query("crop_track", f"WITH RECURSIVE {_CROPS} SELECT * FROM crops")
def crop_track(spark, sf_dir):
    """Filled, smoothed, held and limited centres, and the crop inside the source."""
    return tracks.crop_track(_samples(spark, sf_dir), 1920, 608)


@query("crop_script", f"WITH RECURSIVE {_CROPS} SELECT source_id, frame, printf('%d.%03d crop x %d.%03d;', frame // 30, frame % 30 * 1000 // 30, x // 1000, x % 1000) AS line FROM crops")
def crop_script(spark, sf_dir):
    """One command line a frame."""
    line = F.format_string("%d.%03d crop x %d.%03d;", F.expr("frame div 30"), F.expr("frame % 30 * 1000 div 30"), F.expr("x div 1000"), F.expr("x % 1000"))
    return crop_track(spark, sf_dir).select("source_id", "frame", line.alias("line"))


TRACK_ERRORS = f"""WITH {_TRACK}, v AS (SELECT source_id, count(*) + source_id % 2 AS total FROM s GROUP BY source_id),
    c AS (SELECT source_id, row_number() OVER (PARTITION BY source_id ORDER BY frame) - 1 + source_id % 3 // 2 AS frame, coalesce(cx, 0) AS x, CASE WHEN confidence = 7 THEN 0 WHEN confidence = 8 THEN 700 ELSE 608 END AS width, 1080 AS height FROM s),
    r AS (SELECT *, CASE WHEN width <= 0 THEN 'non-positive crop' WHEN x < -0.5 THEN 'crop origin outside source' WHEN x + width > 1920.5 THEN 'crop exceeds source bounds' WHEN abs(width / height - 0.5625) > 0.01 THEN 'crop aspect does not match output' END AS rule FROM c),
    g AS (SELECT source_id, min(frame) AS lo, max(frame) AS hi, count(*) AS n, arg_min(rule, frame) FILTER (rule IS NOT NULL) AS rule, min(frame) FILTER (rule IS NOT NULL) AS bad FROM r GROUP BY source_id),
    j AS (SELECT v.source_id, concat_ws('; ', CASE WHEN hi - lo + 1 <> n THEN 'frame records are not continuous' END, CASE WHEN lo <> 0 THEN 'frame records must start at 0' END,
          CASE WHEN n <> total THEN 'expected ' || total || ' records, found ' || n END, CASE WHEN rule IS NOT NULL THEN 'frame ' || bad || ': ' || rule END) AS errors FROM v JOIN g USING (source_id))
    SELECT source_id, errors = '' AS passed, errors FROM j"""


@query("track_errors", TRACK_ERRORS)
def track_errors(spark, sf_dir):
    return tracks.track_errors(*checked_crops(spark, sf_dir), 1080, 1920)


def checked_crops(spark, sf_dir):
    """Crops of the coarse track, some of them wrong, and their videos."""
    own = tables.detections(spark, sf_dir)
    videos = own.groupBy("source_id").agg(F.count("*").alias("n")).select("source_id", F.lit(1920).alias("w"), F.lit(1080).alias("h"), (F.col("n") + F.col("source_id") % 2).alias("total"))
    frame = F.expr("row_number() over (partition by source_id order by frame) - 1 + source_id % 3 div 2")
    width = F.when(F.col("confidence") == 7, 0).when(F.col("confidence") == 8, 700).otherwise(608)
    crops = own.select("source_id", frame.cast("long").alias("frame"), F.coalesce("cx", F.lit(0)).alias("x"), F.lit(0).alias("y"), width.alias("width"), F.lit(1080).alias("height"))
    return crops, videos


@query("held_track", f"""WITH RECURSIVE {_FILLED}, dz(source_id, shot_id, i, frame, o) AS (SELECT source_id, shot_id, i, frame, cx FROM filled WHERE i = 1
        UNION ALL SELECT f.source_id, f.shot_id, f.i, f.frame, least(greatest(dz.o, f.cx - 20000), f.cx + 20000) FROM dz JOIN filled f ON f.source_id = dz.source_id AND f.shot_id = dz.shot_id AND f.i = dz.i + 1)
    SELECT source_id, shot_id, frame, o AS cx FROM dz""")
def held_track(spark, sf_dir):
    """A filled track held in a dead zone, chunks of a shot side by side."""
    return tracks.dead_zone(tracks.fill(_samples(spark, sf_dir), 960), 20_000)


_CUES = _segments("""regexp_matches(word, '[.?!]["'')\\]]*$') OR (NOT fin AND gap >= 350) OR n >= 62 OR end_ms - s >= 4000""")
_EVEN = "({0} * 30 // 1000 + CAST({0} * 30 % 1000 > 500 OR ({0} * 30 % 1000 = 500 AND {0} * 30 // 1000 % 2 = 1) AS BIGINT))"
_FRAMES = f"SELECT *, {_EVEN.format('start_ms')} AS sf, {_EVEN.format('end_ms')} AS ef FROM ({_CUES})"


def _cue_frames(spark, sf_dir):
    words = tables.words(spark, sf_dir)
    cues = sequences.cues(words)
    totals = words.groupBy("source_id").agg(F.expr("max(end_ms) * 28 div 1000").cast("long").alias("total"))
    return sequences.cue_frames(cues, totals)


_CUE_FRAMES = f"""WITH {_WORDS}, t AS (SELECT source_id, max(end_ms) * 28 // 1000 AS total FROM words GROUP BY source_id),
    q AS (SELECT f.*, t.total, greatest(sf + 8, coalesce(lead(sf) OVER (PARTITION BY source_id ORDER BY number), ef + 12)) AS e FROM ({_FRAMES}) f JOIN t USING (source_id))
    SELECT source_id, number, sf AS start_frame, least(e, total) AS end_frame, text FROM q WHERE sf < total AND least(e, total) > sf"""


@query("cue_frames", _CUE_FRAMES)
def cue_frames(spark, sf_dir):
    """Cues on the frame grid, each lasting to the next."""
    return _cue_frames(spark, sf_dir)


@query("longest_cue", f"SELECT source_id, max(length(text)) AS longest FROM ({_CUE_FRAMES}) GROUP BY source_id")
def longest_cue(spark, sf_dir):
    return _cue_frames(spark, sf_dir).groupBy("source_id").agg(F.max(F.length("text")).cast("long").alias("longest"))


@query("visible_cues", f"SELECT source_id, number, greatest(start_frame - 30, 75) AS start_frame, least(end_frame - 30, 4000) AS end_frame FROM ({_CUE_FRAMES}) WHERE least(end_frame - 30, 4000) > greatest(start_frame - 30, 75)")
def visible_cues(spark, sf_dir):
    """Cues after a trimmed start, between the gate and the end; those left empty go."""
    own = _cue_frames(spark, sf_dir).select("source_id", "number", F.greatest(F.col("start_frame") - 30, F.lit(75)).alias("start_frame"), F.least(F.col("end_frame") - 30, F.lit(4000)).alias("end_frame"))
    return own.where("end_frame > start_frame")


@query("caption_pages", f"""WITH p AS (SELECT source_id, number, (start_ms * 60 + 1000) // 2000 - 5 AS a, (end_ms * 60 + 1000) // 2000 - 5 AS z FROM ({_CUES})),
    q AS (SELECT source_id, number, greatest(a, 75) AS start_frame, least(5000, coalesce(lead(a) OVER (PARTITION BY source_id ORDER BY number), 5000), z + 9) AS end_frame FROM p)
    SELECT * FROM q WHERE end_frame > start_frame""")
def caption_pages(spark, sf_dir):
    return sequences.caption_pages(sequences.cues(tables.words(spark, sf_dir)), 75, 5000, trim=5)


@query("caption_tokens", f"WITH {_WORDS} SELECT source_id, idx, CASE WHEN idx = 0 THEN word ELSE ' ' || word END AS token FROM words")
def caption_tokens(spark, sf_dir):
    return sequences.caption_tokens(tables.words(spark, sf_dir))


@query("overlap_ratios", """WITH c AS (SELECT user_id AS source_id, event_id, (epoch_us(ts) - 1704067200000000) // 24000000 AS s, 450 + event_id * 37 % 1500 AS n FROM events),
    p AS (SELECT *, lead(event_id) OVER w AS next_id, lead(s) OVER w AS s2, lead(n) OVER w AS n2 FROM c WINDOW w AS (PARTITION BY source_id ORDER BY s, event_id))
    SELECT source_id, event_id, next_id, CAST(greatest(0, least(s + n, s2 + n2) - greatest(s, s2)) AS DOUBLE) / least(n, n2) AS ratio FROM p WHERE next_id IS NOT NULL""")
def overlap_ratios(spark, sf_dir):
    """How much of the shorter range each candidate shares with its successor."""
    from pyspark.sql import Window as W

    own = tables.candidates(spark, sf_dir).select("source_id", "event_id", "start_frame", "end_frame")
    order = W.partitionBy("source_id").orderBy("start_frame", "event_id")
    own = own.withColumns({"next_id": F.lead("event_id").over(order), "s2": F.lead("start_frame").over(order), "e2": F.lead("end_frame").over(order)}).where("next_id is not null")
    shorter = F.least(F.col("end_frame") - F.col("start_frame"), F.col("e2") - F.col("s2"))
    ratio = F.coalesce(F.try_divide(overlap(F.col("start_frame"), F.col("end_frame"), F.col("s2"), F.col("e2")).cast("double"), shorter.cast("double")), F.lit(0.0))
    return own.select("source_id", "event_id", "next_id", F.when(shorter > 0, ratio).otherwise(0.0).alias("ratio"))


@query("median_heights", """WITH e AS (SELECT user_id AS source_id, event_id % 5 AS shot_id, CASE WHEN event_type <> 'error' THEN CAST(floor(value * 8) AS BIGINT) END AS h FROM events)
    SELECT source_id, shot_id, coalesce(median(h), 486.0) AS height FROM e GROUP BY ALL""")
def median_heights(spark, sf_dir):
    """Median subject height of every shot; 45 % of the frame where nothing was seen."""
    height = F.when(F.col("event_type") != "error", F.floor(F.col("value") * 8).cast("long"))
    own = tables.table(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), (F.col("event_id") % 5).alias("shot_id"), height.alias("h"))
    return own.groupBy("source_id", "shot_id").agg(F.coalesce(F.median("h"), F.lit(486.0)).alias("height"))


@query("largest_boxes", """WITH b AS (SELECT user_id AS source_id, event_id, event_id % 100 AS x0, event_id % 70 AS y0, event_id % 100 + event_id % 9 AS x1, event_id % 70 + event_id % 11 AS y1 FROM events)
    SELECT source_id, (x1 - x0) * (y1 - y0) AS area, event_id, x0, y0, x1, y1 FROM b QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY (x1 - x0) * (y1 - y0) DESC, event_id) = 1""")
def largest_boxes(spark, sf_dir):
    e = F.col("event_id")
    own = tables.table(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), e, (e % 100).alias("x0"), (e % 70).alias("y0"), (e % 100 + e % 9).alias("x1"), (e % 70 + e % 11).alias("y1"))
    return media.largest(own, "source_id", "event_id")
