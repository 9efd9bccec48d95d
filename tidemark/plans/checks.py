"""The registered queries over rendered media, runs and reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import printed_rate, seconds_to_frame
from tidemark.operators import findings, media, ranking, runs, tracks
from tidemark.plans.media import _CANDIDATES, _TRACK
from tidemark.plans.registry import query
from tidemark.sources import documents, tables

_MEDIA = """
    m AS (SELECT p_partkey AS media_id, [1080, 720, 1920][p_partkey % 3 + 1] AS width, [1920, 1280, 1080][p_partkey % 3 + 1] AS height, [30000 / 1001.0::DOUBLE, 30.0, 0.0, 0.0, 25.0][p_partkey % 5 + 1] AS fps, p_partkey * 7 % 1000 AS frames,
          [1080, 1080, 0, 1080][p_partkey % 4 + 1] AS ww, 1920 AS wh, [30.0, 29.97, 0.0, 25.0, 30.0, 30.0, 30.0][p_partkey % 7 + 1]::DOUBLE AS wf, p_partkey * 7 % 1000 + p_partkey % 4 - 1 AS wn,
          p_partkey % 211 / 10.0 AS duration, p_partkey % 19 <> 0 AS has_video, p_partkey % 7 <> 0 AS has_audio FROM part),
    f AS (SELECT media_id, unnest(CASE WHEN NOT has_video THEN [{'c': 'video-stream', 's': 'fail', 'd': 'no video stream found'}] ELSE [
        {'c': 'dimensions', 's': CASE WHEN ww = 0 OR (width = ww AND height = wh) THEN 'pass' ELSE 'fail' END,
         'd': CASE WHEN ww = 0 THEN width || 'x' || height || ' (no expectation supplied)' WHEN width = ww AND height = wh THEN width || 'x' || height ELSE 'expected ' || ww || 'x' || wh || ', rendered ' || width || 'x' || height END},
        {'c': 'orientation', 's': CASE WHEN height > width THEN 'pass' ELSE 'warn' END, 'd': CASE WHEN height > width THEN 'vertical' ELSE 'not vertical: ' || width || 'x' || height END},
        {'c': 'fps', 's': CASE WHEN wf = 0 OR abs(fps - wf) < 0.05 THEN 'pass' ELSE 'fail' END,
         'd': CASE WHEN wf = 0 THEN printf('%.3f', fps) || ' (no expectation supplied)' WHEN abs(fps - wf) < 0.05 THEN printf('%.3f', fps) ELSE 'expected ' || wf || printf(', rendered %.3f', fps) END},
        {'c': 'frame-count', 's': CASE WHEN wn = 0 OR abs(frames - wn) <= 1 THEN 'pass' ELSE 'fail' END, 'd': CASE WHEN wn = 0 OR abs(frames - wn) <= 1 THEN CAST(frames AS VARCHAR) ELSE 'expected ' || wn || ', rendered ' || frames END},
        {'c': 'duration', 's': 'pass', 'd': printf('%.3fs', duration)},
        {'c': 'codecs', 's': 'pass', 'd': 'video:h264' || CASE WHEN has_audio THEN ', audio:aac' ELSE '' END}] END) AS r FROM m),
    lm AS (SELECT p_partkey AS media_id, p_partkey AS k, p_partkey % 7 <> 0 AS audio, p_partkey % 211 / 10.0 AS duration, CASE WHEN p_partkey % 13 <> 0 THEN CAST('-' || p_partkey % 70 || '.5' AS DOUBLE) END AS mean,
           CASE WHEN p_partkey % 17 <> 0 THEN CAST('-' || p_partkey * 3 % 90 || '.5' AS DOUBLE) END AS head, CASE WHEN p_partkey % 31 <> 0 THEN CAST('-' || p_partkey * 7 % 90 || '.5' AS DOUBLE) END AS tail,
           CAST('-' || p_partkey % 30 || '.25' AS DOUBLE) AS lufs, CAST('-' || p_partkey % 3 || '.50' AS DOUBLE) AS peak FROM part),
    ln AS (SELECT k AS media_id, mean, duration, head, tail, unnest(list_filter([
        {'c': 'decode', 's': CASE WHEN k % 3 = 0 THEN 'pass' ELSE 'fail' END, 'd': CASE WHEN k % 3 = 0 THEN 'every frame decoded cleanly' ELSE k % 3 || ' decode error(s)' END},
        {'c': 'frozen-frames', 's': CASE WHEN k % 4 = 0 THEN 'pass' ELSE 'warn' END, 'd': CASE WHEN k % 4 = 0 THEN 'none detected' ELSE k % 4 || ' frozen stretch(es) of 1s or longer' END},
        CASE WHEN NOT audio THEN {'c': 'audio-present', 's': 'fail', 'd': 'no audio stream'} END,
        CASE WHEN audio THEN {'c': 'audio-level', 's': CASE WHEN mean IS NULL THEN 'warn' WHEN mean <= -60 THEN 'fail' ELSE 'pass' END,
            'd': CASE WHEN mean IS NULL THEN 'could not measure mean volume' WHEN mean <= -60 THEN printf('silent: %.1f dB mean', mean) ELSE printf('%.1f dB mean', mean) END} END,
        CASE WHEN audio THEN {'c': 'loudness', 's': CASE WHEN k % 23 <> 0 AND k % 29 <> 0 AND lufs BETWEEN -16 AND -8 THEN 'pass' ELSE 'warn' END,
            'd': CASE WHEN k % 23 = 0 THEN 'could not measure loudness' WHEN k % 29 = 0 THEN 'loudness output was not parseable' WHEN lufs BETWEEN -16 AND -8 THEN printf('%.1f LUFS integrated', lufs - 0.01)
                      ELSE printf('%.1f LUFS, not in -16.0 to -8.0', lufs - 0.01) END} END,
        CASE WHEN audio AND k % 23 <> 0 AND k % 29 <> 0 THEN {'c': 'true-peak', 's': CASE WHEN peak > -0.1 THEN 'fail' ELSE 'pass' END, 'd': CASE WHEN peak > -0.1 THEN printf('%.2f dBTP, over -0.1', peak) ELSE printf('%.2f dBTP', peak) END} END,
        CASE WHEN audio AND (duration <= 0.6 OR mean IS NULL) THEN {'c': 'boundaries', 's': 'warn', 'd': CASE WHEN duration <= 0.6 THEN 'too short for its edges' ELSE 'mean level unknown' END} END,
        CASE WHEN audio AND duration > 0.6 AND mean IS NOT NULL THEN {'c': 'boundary-head', 's': CASE WHEN head <= mean - 8 THEN 'pass' ELSE 'warn' END,
            'd': CASE WHEN head IS NULL THEN 'could not measure' WHEN head <= mean - 8 THEN printf('%.1f dB, mean %.1f dB', head, mean)
                      ELSE printf('%.1f dB in the first 0.15s, mean %.1f dB: may start inside a word', head, mean) END} END,
        CASE WHEN audio AND duration > 0.6 AND mean IS NOT NULL THEN {'c': 'boundary-tail', 's': CASE WHEN tail <= mean - 8 THEN 'pass' ELSE 'warn' END,
            'd': CASE WHEN tail IS NULL THEN 'could not measure' WHEN tail <= mean - 8 THEN printf('%.1f dB, mean %.1f dB', tail, mean)
                      ELSE printf('%.1f dB in the last 0.15s, mean %.1f dB: may end inside a word', tail, mean) END} END], lambda x: x IS NOT NULL)) AS r FROM lm)
"""


@query("spec_findings", f"WITH {_MEDIA} SELECT media_id, r.c AS check, r.s AS status, r.d AS detail FROM f")
def spec_findings(spark, sf_dir):
    return media.spec_findings(tables.media(spark, sf_dir), "media_id")


def _level_findings(spark, sf_dir):
    return media.level_findings(media.logged_levels(tables.measurements(spark, sf_dir)), "media_id")


@query("level_findings", f"WITH {_MEDIA} SELECT media_id, r.c AS check, r.s AS status, r.d AS detail FROM ln")
def level_findings(spark, sf_dir):
    """What the logs of measuring tools say about levels, loudness, edges, still stretches and decoding."""
    return _level_findings(spark, sf_dir)


@query("media_verdicts", f"""WITH {_MEDIA}, a AS (SELECT media_id, r.s AS s FROM f UNION ALL SELECT media_id, r.s FROM ln),
    g AS (SELECT media_id, CAST(count_if(s = 'fail') AS BIGINT) AS n_fail, CAST(count_if(s = 'warn') AS BIGINT) AS n_warn, CAST(count_if(s = 'pass') AS BIGINT) AS n_pass FROM a GROUP BY media_id)
    SELECT media_id, CASE WHEN n_fail > 0 THEN 'fail' WHEN n_warn > 0 THEN 'warn' ELSE 'pass' END AS verdict, n_fail, n_warn, n_pass FROM g""")
def media_verdicts(spark, sf_dir):
    """All findings of a medium, of its format and of its measurements, rolled up."""
    return findings.report(media.spec_findings(tables.media(spark, sf_dir), "media_id").unionByName(_level_findings(spark, sf_dir)), "media_id")


@query("black_ranges", """WITH p AS (SELECT p_partkey AS media_id, p_partkey % 8 AS n, p_partkey % 3 AS o FROM part WHERE true)
    SELECT media_id, CASE WHEN n = 0 THEN 'pass' WHEN o = 0 THEN 'fail' ELSE 'warn' END AS status, CAST(least(n, 7) AS BIGINT) AS n_ranges,
           array_to_string(list_transform(range(0, least(n, 5)), lambda i: (o + i) || '.25-' || (o + i + 1)), ', ') AS ranges FROM p""")
def black_ranges(spark, sf_dir):
    return media.black_ranges(tables.media_logs(spark, sf_dir), "media_id")


@query("crop_sizes", f"""WITH {_MEDIA} SELECT media_id, CASE WHEN width * 16 >= height * 9 THEN height * 9 / 16 ELSE CAST(width AS DOUBLE) END AS crop_width, CASE WHEN width * 16 >= height * 9 THEN CAST(height AS DOUBLE) ELSE width * 16 / 9 END AS crop_height FROM m""")
def crop_sizes(spark, sf_dir):
    return tables.media(spark, sf_dir).select("media_id", media.crop_size(F.col("width"), F.col("height"), 9, 16).alias("c")).select("media_id", F.col("c.width").alias("crop_width"), F.col("c.height").alias("crop_height"))


@query("frame_times", """SELECT event_id, CAST(floor(ms * 2997 / 100000) AS BIGINT) AS floor_frame, CAST((ms * 2997 + 99999) // 100000 AS BIGINT) AS ceil_frame, CAST((ms * 2997 * 2 + 100000) // 200000 AS BIGINT) AS nearest_frame
    FROM (SELECT event_id, event_id * 7919 % 10000000 AS ms FROM events)""")
def frame_times(spark, sf_dir):
    """Times in thousandths of a second as frames at 29.97, by all three roundings."""
    seconds = (F.col("event_id") * 7919 % 10_000_000).cast("decimal(12,0)") / F.lit(1000).cast("decimal(4,0)")
    frame = lambda mode: seconds_to_frame(seconds.cast("decimal(12,3)"), "29.97", mode).alias(f"{mode}_frame")
    return tables.table(spark, sf_dir, "events").select("event_id", frame("floor"), frame("ceil"), frame("nearest"))


@query("run_errors", """WITH h AS (SELECT l_orderkey AS run_id, l_linenumber AS clip, l_partkey AS cid, p_partkey IS NOT NULL AS known, p_partkey * 3 % 5000 AS fid, p_partkey % 4 AS sha, c_custkey AS f, c_custkey * 7 % 4 AS cur
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size % 7 <> 0 LEFT JOIN customer ON c_custkey = p_partkey * 3 % 5000),
    e AS (SELECT run_id, clip, CASE WHEN NOT known THEN 'missing contract: ' || cid WHEN f IS NULL THEN 'missing media: ' || fid WHEN cur <> sha THEN 'stale media: ' || fid END AS error FROM h),
    g AS (SELECT run_id, count(*) AS n_clips, list(error ORDER BY clip, error) FILTER (error IS NOT NULL) AS es FROM e GROUP BY run_id),
    r AS (SELECT o_orderkey AS run_id, list_concat(CASE WHEN o_custkey % 5 = 0 THEN ['source fingerprint changed'] ELSE [] END, CASE WHEN o_orderkey % 6 = 0 THEN ['ranked-shorts.json is missing'] ELSE [] END, coalesce(es, [])) AS es, coalesce(n_clips, 0) AS n_clips
          FROM orders LEFT JOIN g ON run_id = o_orderkey)
    SELECT run_id, len(es) = 0 AS ready, n_clips, array_to_string(es, '; ') AS errors FROM r""")
def run_errors(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    own = tables.table(spark, sf_dir, "orders").select(k.alias("run_id"), F.lit("a").alias("sha_planned"), F.when(c % 5 == 0, "b").otherwise("a").alias("sha_now"), F.when(k % 6 != 0, True).alias("ranked"))
    return runs.run_errors(tables.manifest(spark, sf_dir), tables.contracts(spark, sf_dir), tables.files(spark, sf_dir), own)


@query("approvals", """SELECT o_orderkey AS run_id, b = '' AS ready, b AS blockers FROM (SELECT o_orderkey, concat_ws('; ', CASE WHEN o_orderkey % 5 = 0 THEN 'validation failed' END,
        CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 4) || ' unresolved uncertainty ranges' END, CASE WHEN o_custkey % 3 = 0 THEN 'source file changed since planning' END) AS b FROM orders)""")
def approvals(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    errors = F.when(k % 5 == 0, F.array(F.lit("validation failed"))).otherwise(F.array().cast("array<string>"))
    return runs.approvals(tables.table(spark, sf_dir, "orders").select(k.alias("run_id"), errors.alias("errors"), (k % 4).alias("n_unresolved"), F.lit("a").alias("sha_planned"), F.when(c % 3 == 0, "b").otherwise("a").alias("sha_now")))


@query("review_states", """WITH RECURSIVE l AS MATERIALIZED (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, CASE event_type WHEN 'signup' THEN 'plan' WHEN 'purchase' THEN 'plan-uncertain' WHEN 'error' THEN 'fail' WHEN 'click' THEN 'accept'
        ELSE CASE WHEN event_id % 2 = 0 THEN 'approve' ELSE 'publish' END END AS a FROM events),
    r(run_id, k, status, n) AS (SELECT DISTINCT run_id, CAST(0 AS BIGINT), 'new', CAST(0 AS BIGINT) FROM l UNION ALL
        SELECT run_id, k, coalesce(t, status), n + CAST(t IS NULL AS BIGINT) FROM (SELECT l.run_id, l.k, r.status, r.n, CASE WHEN a = 'plan' THEN 'review-pending' WHEN a = 'plan-uncertain' THEN 'uncertain' WHEN a = 'fail' THEN 'failed'
            WHEN a = 'accept' AND status = 'uncertain' THEN 'review-pending' WHEN a = 'approve' AND status = 'review-pending' THEN 'ready' WHEN a = 'publish' AND status = 'ready' THEN 'published' END AS t
            FROM r JOIN l ON l.run_id = r.run_id AND l.k = r.k + 1))
    SELECT run_id, status, n AS n_refused FROM r QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY k DESC) = 1""")
def review_states(spark, sf_dir):
    return runs.review_states(tables.reviews(spark, sf_dir))


@query("leftover_tokens", r"""SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(replace(replace(text, ' er', ' __ER__'), 'sh,', '__SH_LEFT__x__lower__'), '__[A-Z_]+__'))), ',') AS tokens
    FROM documents WHERE len(regexp_extract_all(replace(replace(text, ' er', ' __ER__'), 'sh,', '__SH_LEFT__x__lower__'), '__[A-Z_]+__')) > 0""")
def leftover_tokens(spark, sf_dir):
    text = F.replace(F.replace(F.col("text"), F.lit(" er"), F.lit(" __ER__")), F.lit("sh,"), F.lit("__SH_LEFT__x__lower__"))
    return runs.leftover_tokens(tables.table(spark, sf_dir, "documents").select("doc_id", text.alias("text")), "doc_id")


_CLIPS = f"""{_CANDIDATES},
    clips AS (SELECT source_id, CAST(place AS INTEGER) AS rank, id, start_frame, end_frame, topic_key, CAST(composite AS DOUBLE) AS composite, n, CASE WHEN source_id % 5 = 0 THEN 29.97 ELSE 30.0 END::DOUBLE AS fps FROM p WHERE place <= 5)"""


def _clips(spark, sf_dir):
    own = ranking.rank(tables.candidates(spark, sf_dir)).where("status = 'selected'")
    fps = F.when(F.col("source_id") % 5 == 0, 29.97).otherwise(30.0)
    return own.withColumn("n", F.col("end_frame") - F.col("start_frame")).withColumn("fps", fps).withColumn("composite", F.col("composite").cast("double"))


@query("clip_contracts", f"""WITH RECURSIVE {_CLIPS} SELECT source_id, rank, printf('%02d-%s', rank, id) AS name, n AS end_frame, CASE WHEN fps = 30 THEN '30' ELSE '29.97' END AS fps,
    least(75, greatest(0, n - 1)) AS hook_frames, n // 2 AS mid_frame FROM clips""")
def clip_contracts(spark, sf_dir):
    """Name, timeline and hook card of every selected clip."""
    own = _clips(spark, sf_dir)
    hook = F.least(F.bround(F.col("fps") * 2.5, 0).cast("long"), F.greatest(F.lit(0), F.col("n") - 1))
    return own.select("source_id", "rank", F.format_string("%02d-%s", "rank", "id").alias("name"), F.col("n").alias("end_frame"), printed_rate(F.col("fps")).alias("fps"), hook.alias("hook_frames"), F.expr("n div 2").alias("mid_frame"))


@query("clip_documents", f"""WITH RECURSIVE {_CLIPS} SELECT source_id, id, CAST(json_object('schemaVersion', 1, 'rangeSemantics', '[startFrame,endFrameExclusive)', 'id', id, 'rank', rank,
    'source', json_object('parentSha256', sha256(CAST(source_id AS VARCHAR)), 'sourceRange', json_object('startFrame', start_frame, 'endFrameExclusive', end_frame)),
    'timeline', json_object('startFrame', 0, 'endFrameExclusive', n, 'fps', fps, 'width', 1080, 'height', 1920), 'selection', json_object('composite', composite, 'topicKey', topic_key, 'hookText', NULL)) AS VARCHAR) AS document FROM clips""")
def clip_documents(spark, sf_dir):
    """The contract of every selected clip as one nested document."""
    own = _clips(spark, sf_dir)
    return documents.contract_documents(own.select("*", F.sha2(F.col("source_id").cast("string").cast("binary"), 256).alias("sha256"), F.col("n").alias("n_frames"), F.lit(1080).alias("width"), F.lit(1920).alias("height")))


@query("expected_specs", """WITH c AS (SELECT p_partkey AS media_id, p_partkey AS k, p_size AS z, p_partkey % 2 = 0 AND p_partkey % 7 > 0 AS cut, p_partkey % 2 = 0 AS source FROM part),
    e AS (SELECT media_id, CASE WHEN k % 3 <> 0 THEN 1080 ELSE 0 END AS w, CASE WHEN k % 5 = 0 THEN 1350 END AS h, CASE WHEN k % 4 = 0 THEN 25.0 WHEN k % 4 = 1 THEN 0.0 END::DOUBLE AS f, CASE WHEN k % 9 = 0 THEN k ELSE 0 END AS n,
          CASE WHEN cut THEN CASE WHEN k % 5 > 1 THEN 720 ELSE 0 END WHEN z > 10 THEN z END AS cw, CASE WHEN cut THEN 1280 ELSE 1920 END AS ch, CASE WHEN cut THEN NULL ELSE 30.0 END::DOUBLE AS cf, CASE WHEN cut AND k % 3 > 0 THEN k % 3 * 100 END AS cn, k % 50 AS tn FROM c)
    SELECT media_id, coalesce(nullif(w, 0), nullif(cw, 0)) AS want_width, coalesce(nullif(h, 0), nullif(ch, 0)) AS want_height, coalesce(nullif(f, 0), nullif(cf, 0)) AS want_fps, coalesce(nullif(n, 0), nullif(cn, 0), nullif(tn, 0)) AS want_frames FROM e""")
def expected_specs(spark, sf_dir):
    """What is expected of a medium: asked for, else of its contract at its stage; 0 and null ask for nothing."""
    k = F.col("p_partkey")
    cut = F.when((k % 2 == 0) & (k % 7 > 0), F.struct(F.when(k % 5 > 1, 720).otherwise(0).alias("width"), F.lit(1280).alias("height"), F.lit(None).cast("double").alias("fps"), F.when(k % 3 > 0, k % 3 * 100).alias("totalFrames")))
    timeline = F.struct(F.when(F.col("p_size") > 10, F.col("p_size")).alias("width"), F.lit(1920).alias("height"), F.lit(30.0).alias("fps"), F.lit(None).cast("long").alias("totalFrames"), (k % 50).alias("endFrameExclusive"), cut.alias("materialized"))
    asked = F.struct(F.when(k % 3 != 0, 1080).otherwise(0).alias("width"), F.when(k % 5 == 0, 1350).alias("height"), F.when(k % 4 == 0, 25.0).when(k % 4 == 1, 0.0).alias("fps"), F.when(k % 9 == 0, k).otherwise(0).alias("frames"))
    want = media.expected_spec(asked, timeline, F.when(k % 2 == 0, "source").otherwise("render"))
    return tables.table(spark, sf_dir, "part").select(k.alias("media_id"), want.alias("w")).select("media_id", *(F.col(f"w.{c}").alias(f"want_{c}") for c in ("width", "height", "fps", "frames")))


@query("box_centres", """SELECT event_id, (event_id % 100 + event_id % 100 + event_id % 9) / 2.0::DOUBLE AS cx, (event_id % 70 + event_id % 70 + event_id % 11) / 2.0::DOUBLE AS cy, event_id % 11 AS height FROM events""")
def box_centres(spark, sf_dir):
    e = F.col("event_id")
    own = tables.table(spark, sf_dir, "events").select(e, (e % 100).alias("x0"), (e % 70).alias("y0"), (e % 100 + e % 9).alias("x1"), (e % 70 + e % 11).alias("y1"))
    return own.select("event_id", ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"), (F.col("y1") - F.col("y0")).alias("height"))


@query("accepted_ranges", f"""WITH {_TRACK}, w AS (SELECT source_id, frame, confidence < 30 AS weak, lead(frame) OVER o AS following, row_number() OVER o AS i FROM t WINDOW o AS (PARTITION BY source_id ORDER BY frame)),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY source_id, weak ORDER BY frame) AS run FROM w),
    r AS (SELECT source_id, min(frame) AS start_frame, max(coalesce(following, frame + 1)) AS end_frame FROM g WHERE weak GROUP BY source_id, run)
    SELECT source_id, count(*) FILTER (end_frame - start_frame <= 5) AS n_accepted, count(*) FILTER (end_frame - start_frame > 5) AS n_unresolved, 'dev' AS reviewed_by FROM r GROUP BY source_id""")
def accepted_ranges(spark, sf_dir):
    """Weak ranges of a source that a review accepts (the short ones) and those left open."""
    own = tracks.weak_ranges(tracks.interpolate(tables.detections(spark, sf_dir)), 30)
    short = F.col("end_frame") - F.col("start_frame") <= 5
    return own.groupBy("source_id").agg(F.count_if(short).alias("n_accepted"), F.count_if(~short).alias("n_unresolved")).withColumn("reviewed_by", F.lit("dev"))
