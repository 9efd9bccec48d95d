"""The registered queries over candidates, words, tracks and findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import findings as checks
from tidemark.operators import ranking, sequences, tracks
from tidemark.plans.registry import query
from tidemark.sources import tables

_CANDIDATES = """
    e AS (SELECT user_id AS source_id, event_id, event_type AS topic_key, (epoch_us(ts) - 1704067200000000) // 24000000 AS start_frame,
          (epoch_us(ts) - 1704067200000000) // 24000000 + 450 + event_id * 37 % 1500 AS end_frame,
          CASE WHEN user_id % 4 = 1 THEN 60 ELSE 30 END AS fps,
          event_id * 7 % 103 AS a, event_id * 11 % 103 AS b, CASE WHEN event_id % 29 <> 0 THEN event_id * 13 % 103 END AS c, event_id * 17 % 103 AS d, event_id * 19 % 103 AS f FROM events),
    c AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN 'clip' || event_id ELSE substr(sha256(source_id || ':' || start_frame || ':' || end_frame), 1, 12) END AS id, end_frame - start_frame AS n,
          CAST((30 * a + 20 * b + 15 * c + 20 * d + 15 * f) / 1000.0 AS DECIMAL(8,3)) AS composite,
          concat_ws('; ', CASE WHEN end_frame - start_frame < 20 * fps THEN 'below minimum duration' END, CASE WHEN end_frame - start_frame > 60 * fps THEN 'above maximum duration' END,
                    CASE WHEN event_id % 11 = 0 THEN 'blocking flags: midSentence' END,
                    CASE WHEN a > 100 THEN 'score hook must be between 0 and 10' WHEN b > 100 THEN 'score selfContainedness must be between 0 and 10' WHEN c IS NULL THEN 'score emotion is missing' WHEN c > 100 THEN 'score emotion must be between 0 and 10'
                         WHEN d > 100 THEN 'score payoffDensity must be between 0 and 10' WHEN f > 100 THEN 'score retention must be between 0 and 10' END) AS errors FROM e),
    v AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY composite DESC, start_frame, id, event_id) AS k FROM c WHERE errors = ''),
    g(source_id, k, kept, lost) AS (
        SELECT source_id, CAST(0 AS BIGINT), CAST([] AS STRUCT(id VARCHAR, s BIGINT, t BIGINT)[]), CAST(NULL AS VARCHAR) FROM (SELECT DISTINCT source_id FROM v)
        UNION ALL
        SELECT v.source_id, v.k,
               CASE WHEN len(list_filter(g.kept, lambda x: 2 * greatest(0, least(x.t, v.end_frame) - greatest(x.s, v.start_frame)) >= least(x.t - x.s, v.n))) = 0
                    THEN list_append(g.kept, {'id': v.id, 's': v.start_frame, 't': v.end_frame}) ELSE g.kept END,
               list_filter(g.kept, lambda x: 2 * greatest(0, least(x.t, v.end_frame) - greatest(x.s, v.start_frame)) >= least(x.t - x.s, v.n))[1].id
        FROM g JOIN v ON v.source_id = g.source_id AND v.k = g.k + 1),
    j AS (SELECT v.*, g.lost FROM v JOIN g USING (source_id, k)),
    q AS (SELECT *, row_number() OVER (PARTITION BY source_id, topic_key ORDER BY k) > 1 AS again FROM j WHERE lost IS NULL),
    p AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY again, k) AS place FROM q)
"""

_WORDS = r"""
    x AS (SELECT conv_id AS source_id, turn, w, unnest(range(1, len(w) + 1)) AS pos FROM (SELECT *, regexp_extract_all(text, '[^ \t\n\r]+') AS w FROM conversations)),
    y AS (SELECT source_id, turn, w[pos] AS word, row_number() OVER (PARTITION BY source_id ORDER BY turn, pos) - 1 AS idx FROM x),
    z AS (SELECT source_id, idx, word, idx * 400 + turn * 1000 - CASE WHEN idx % 17 = 5 THEN 900 ELSE 0 END AS start_ms, idx % 17 = 11 AS empty FROM y),
    words AS MATERIALIZED (SELECT source_id, idx, word, start_ms, start_ms + CASE WHEN empty THEN 0 ELSE 320 END AS end_ms FROM z)
"""

_TRACK = """
    e AS (SELECT user_id AS source_id, event_id, event_type, value, (epoch_us(ts) - 1704067200000000) // 1200000000 AS frame FROM events),
    s AS (SELECT source_id, frame, frame // 240 AS shot_id, CASE WHEN event_type <> 'error' THEN CAST(floor(value * 16) AS BIGINT) % 1920 END AS cx, event_id % 100 AS confidence
          FROM e QUALIFY row_number() OVER (PARTITION BY source_id, frame ORDER BY event_id) = 1),
    a AS (SELECT *, CASE WHEN cx IS NOT NULL THEN {'f': frame, 'x': cx, 'c': confidence} END AS an FROM s),
    b AS (SELECT *, last_value(an IGNORE NULLS) OVER (PARTITION BY source_id, shot_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p,
                    first_value(an IGNORE NULLS) OVER (PARTITION BY source_id, shot_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n,
                    last_value(an IGNORE NULLS) OVER (PARTITION BY source_id, shot_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS z FROM a),
    t AS (SELECT source_id, shot_id, frame,
                 CASE WHEN z IS NULL THEN NULL WHEN p IS NULL THEN n.x * 1000 WHEN frame >= z.f THEN z.x * 1000
                      ELSE p.x * 1000 + CAST(trunc(((n.x - p.x) * 1000 * (frame - p.f)) / (n.f - p.f)) AS BIGINT) END AS cx,
                 CASE WHEN z IS NULL THEN 0 WHEN p IS NULL THEN n.c WHEN frame >= z.f THEN z.c ELSE least(p.c, n.c) END AS confidence FROM b)
"""


@query("rank_topk", f"WITH RECURSIVE {_CANDIDATES} SELECT source_id, CAST(place AS INTEGER) AS rank, id, composite, start_frame, end_frame, topic_key FROM p WHERE place <= 5")
def rank_topk(spark, sf_dir):
    """The selected candidates of every source, by rank."""
    return ranking.rank(tables.candidates(spark, sf_dir)).where("status = 'selected'").select("source_id", "rank", "id", "composite", "start_frame", "end_frame", "topic_key")


@query("rank_reasons", f"""WITH RECURSIVE {_CANDIDATES}
    SELECT source_id, event_id, id, CASE WHEN place <= 5 THEN 'selected' ELSE 'rejected' END AS status, CASE WHEN place <= 5 THEN 'ranked by composite and diversity' ELSE 'outside requested count' END AS reasons FROM p
    UNION ALL SELECT source_id, event_id, id, 'rejected', 'overlaps ' || lost FROM j WHERE lost IS NOT NULL
    UNION ALL SELECT source_id, event_id, id, 'rejected', errors FROM c WHERE errors <> ''""")
def rank_reasons(spark, sf_dir):
    """Every candidate with its state and why, in the order of the report."""
    return ranking.in_order(ranking.rank(tables.candidates(spark, sf_dir))).select("source_id", "event_id", "id", "status", "reasons")


@query("word_errors", f"""WITH {_WORDS}, l AS (SELECT *, lag(start_ms) OVER w AS ps, lag(end_ms) OVER w AS pe FROM words WINDOW w AS (PARTITION BY source_id ORDER BY idx))
    SELECT source_id, idx, 'invalid range' AS error FROM l WHERE start_ms < 0 OR end_ms <= start_ms
    UNION ALL SELECT source_id, idx, 'not monotonic' FROM l WHERE start_ms < ps OR end_ms < pe""")
def word_errors(spark, sf_dir):
    return sequences.word_errors(tables.words(spark, sf_dir))


@query("word_repair", f"""WITH RECURSIVE {_WORDS}, r(source_id, idx, start_ms, end_ms) AS (
        SELECT source_id, CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM (SELECT DISTINCT source_id FROM words)
        UNION ALL SELECT w.source_id, w.idx, greatest(w.start_ms, r.end_ms), greatest(w.end_ms, greatest(w.start_ms, r.end_ms) + 10) FROM r JOIN words w ON w.source_id = r.source_id AND w.idx = r.idx + 1)
    SELECT r.source_id, r.idx, w.word, r.start_ms, r.end_ms FROM r JOIN words w USING (source_id, idx)""")
def word_repair(spark, sf_dir):
    return sequences.repair(tables.words(spark, sf_dir))


def _segments(close: str) -> str:
    return f"""WITH RECURSIVE {_WORDS}, l AS MATERIALIZED (SELECT *, coalesce(lead(start_ms) OVER w - end_ms, 0) AS gap, lead(idx) OVER w IS NULL AS fin FROM words WINDOW w AS (PARTITION BY source_id ORDER BY idx)),
        r(source_id, idx, s, n, number, shut) AS (
            SELECT source_id, CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(-1 AS BIGINT), true FROM (SELECT DISTINCT source_id FROM l)
            UNION ALL SELECT source_id, idx, s, n, number, {close}
            FROM (SELECT l.source_id, l.idx, CASE WHEN r.shut THEN l.start_ms ELSE r.s END AS s, CASE WHEN r.shut THEN 0 ELSE r.n + 1 END + len(l.word) AS n, r.number + CAST(r.shut AS INTEGER) AS number, l.end_ms, l.gap, l.fin, l.word
                  FROM r JOIN l ON l.source_id = r.source_id AND l.idx = r.idx + 1))
        SELECT r.source_id, r.number, min(r.idx) AS from_idx, max(r.idx) + 1 AS to_idx, arg_min(l.start_ms, r.idx) AS start_ms, arg_max(l.end_ms, r.idx) AS end_ms, string_agg(l.word, ' ' ORDER BY r.idx) AS text
        FROM r JOIN l USING (source_id, idx) GROUP BY r.source_id, r.number"""


WINDOWS = "SELECT *, printf('window-%04d', CAST(number + 1 AS INTEGER)) AS id FROM (" + _segments("end_ms - s >= 12000 OR (end_ms - s >= 8000 AND (regexp_matches(word, '[.?!]$') OR gap >= 1000)) OR (end_ms - s >= 10000 AND gap >= 350)") + ")"


@query("semantic_windows", WINDOWS)
def semantic_windows(spark, sf_dir):
    return sequences.semantic_windows(tables.words(spark, sf_dir))


@query("cue_groups", _segments("""regexp_matches(word, '[.?!]["'')\\]]*$') OR (NOT fin AND gap >= 350) OR n >= 62 OR end_ms - s >= 4000"""))
def cue_groups(spark, sf_dir):
    return sequences.cues(tables.words(spark, sf_dir))


@query("rebase_words", f"""WITH {_WORDS}, k AS (SELECT *, unnest([0, 1, 2]) AS clip_id FROM (SELECT DISTINCT source_id FROM words))
    SELECT w.source_id, k.clip_id, w.word, greatest(0, w.start_ms - (k.clip_id * 50000 + 1500)) AS start_ms, least(w.end_ms, k.clip_id * 50000 + 91500) - (k.clip_id * 50000 + 1500) AS end_ms,
           w.idx AS parent_idx, w.start_ms AS parent_start_ms, w.end_ms AS parent_end_ms
    FROM words w JOIN k ON k.source_id = w.source_id AND w.end_ms > k.clip_id * 50000 + 1500 AND w.start_ms < k.clip_id * 50000 + 91500""")
def rebase_words(spark, sf_dir):
    """Words of three overlapping clips of every source, in clip-local time."""
    words = tables.words(spark, sf_dir)
    clips = words.select("source_id").distinct().select("source_id", F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("clip_id"))
    clips = clips.withColumn("clip_start", (F.col("clip_id") * 50000 + 1500).cast("long")).withColumn("clip_end", F.col("clip_start") + 90000)
    return sequences.rebase(words, clips)


@query("interpolate_track", f"WITH {_TRACK} SELECT * FROM t")
def interpolate_track(spark, sf_dir):
    return tracks.interpolate(tables.detections(spark, sf_dir))


@query("weak_track_ranges", f"""WITH {_TRACK}, w AS (SELECT source_id, frame, confidence < 30 AS weak, lead(frame) OVER o AS following, row_number() OVER o AS i FROM t WINDOW o AS (PARTITION BY source_id ORDER BY frame)),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY source_id, weak ORDER BY frame) AS run FROM w)
    SELECT source_id, min(frame) AS start_frame, max(coalesce(following, frame + 1)) AS end_frame FROM g WHERE weak GROUP BY source_id, run""")
def weak_track_ranges(spark, sf_dir):
    return tracks.weak_ranges(tracks.interpolate(tables.detections(spark, sf_dir)), 30)


@query("smooth_track", f"""WITH {_TRACK}, u AS (SELECT *, row_number() OVER (PARTITION BY source_id, shot_id ORDER BY frame) AS i FROM t WHERE cx IS NOT NULL),
    h AS (SELECT source_id, shot_id, max(i) AS n FROM u GROUP BY ALL),
    o AS (SELECT u.source_id, u.shot_id, u.frame, greatest(1, least(h.n, u.i + k)) AS at, k FROM u JOIN (SELECT *, CASE WHEN n >= 5 THEN 5 WHEN n >= 3 THEN 3 ELSE 1 END AS w FROM h) h USING (source_id, shot_id), (SELECT unnest([-2, -1, 0, 1, 2]) AS k) WHERE 2 * abs(k) < w)
    SELECT o.source_id, o.shot_id, o.frame, CAST(sum(u.cx) AS BIGINT) AS total, count(*) AS width FROM o JOIN u ON u.source_id = o.source_id AND u.shot_id = o.shot_id AND u.i = o.at GROUP BY ALL""")
def smooth_track(spark, sf_dir):
    own = tracks.smooth(tracks.interpolate(tables.detections(spark, sf_dir)).where("cx is not null"))
    return own.select("source_id", "shot_id", "frame", "total", "width")


@query("findings_report", """WITH f AS (SELECT d.doc_id, unnest([CASE WHEN n_chars < 100 THEN 'fail' WHEN n_chars < 400 THEN 'warn' ELSE 'pass' END, CASE WHEN lang IN ('en', 'de', 'fr') THEN 'pass' ELSE 'warn' END,
        CASE WHEN quality IS NULL THEN 'warn' WHEN quality = 1 THEN 'pass' ELSE 'fail' END, CASE WHEN toxic = 1 THEN 'fail' ELSE 'pass' END]) AS status FROM documents d LEFT JOIN labels USING (doc_id))
    SELECT doc_id, CASE WHEN n_fail > 0 THEN 'fail' WHEN n_warn > 0 THEN 'warn' ELSE 'pass' END AS verdict, n_fail, n_warn, n_pass
    FROM (SELECT doc_id, CAST(count_if(status = 'fail') AS BIGINT) AS n_fail, CAST(count_if(status = 'warn') AS BIGINT) AS n_warn, CAST(count_if(status = 'pass') AS BIGINT) AS n_pass FROM f GROUP BY doc_id)""")
def findings_report(spark, sf_dir):
    return checks.report(checks.findings(tables.table(spark, sf_dir, "documents"), tables.table(spark, sf_dir, "labels")), "doc_id")


@query("fingerprints", """SELECT doc_id, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes, min(doc_id) OVER (PARTITION BY sha256(text)) AS first_doc_id FROM documents""")
def fingerprints(spark, sf_dir):
    """Content hash and size of every document, and the first document with the same content."""
    own = tables.table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.octet_length("text").cast("long").alias("size_bytes"))
    return own.join(own.groupBy("sha256").agg(F.min("doc_id").alias("first_doc_id")), "sha256")
