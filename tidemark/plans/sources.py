"""The registered queries over documents and files: written from the tables, read back by the library's sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import ranking, runs, sequences, tracks
from tidemark.plans.footage import TRACK_ERRORS, checked_crops
from tidemark.plans.frames import _WEAK, _stretches
from tidemark.plans.media import _CANDIDATES, _WORDS, WINDOWS
from tidemark.plans.registry import query
from tidemark.sources import documents, files, tables


def _number(file: str = "file"):
    return F.regexp_extract(file, r"([0-9]+)\.[a-z]+$", 1).cast("long")


def _written(spark, rows):
    """The documents of `rows` as files in a new folder, and the folder."""
    folder = files.scratch_folder(spark)
    files.write_texts(rows, folder)
    return folder


def _transcripts(spark, sf_dir):
    return documents.read_documents(spark, _written(spark, tables.transcript_documents(spark, sf_dir)), "transcript")


@query("transcript_windows", f"SELECT * FROM ({WINDOWS}) WHERE source_id % 11 <> 0 AND source_id % 13 <> 0")
def transcript_windows(spark, sf_dir):
    """Semantic windows of the transcripts that could be read."""
    words = documents.words_of(_transcripts(spark, sf_dir)).withColumn("source_id", _number("source_id"))
    return sequences.semantic_windows(words)


@query("documents_set_aside", "SELECT DISTINCT conv_id AS source_id, CASE WHEN conv_id % 13 = 0 THEN 'empty file' ELSE 'not JSON' END AS error FROM conversations WHERE conv_id % 11 = 0 OR conv_id % 13 = 0")
def documents_set_aside(spark, sf_dir):
    """Transcripts that could not be read, and why."""
    out = documents.set_aside(_transcripts(spark, sf_dir))
    return out.select(_number().alias("source_id"), F.substring_index("error", ":", 1).alias("error"))


@query("transcript_errors", f"""WITH {_WORDS}, l AS (SELECT *, lag(start_ms) OVER w AS ps, lag(end_ms) OVER w AS pe FROM words WINDOW w AS (PARTITION BY source_id ORDER BY idx)),
    e AS (SELECT source_id, idx, 2 AS c, 'invalid range' AS error FROM l WHERE start_ms < 0 OR end_ms <= start_ms UNION ALL SELECT source_id, idx, 3, 'not monotonic' FROM l WHERE start_ms < ps OR end_ms < pe)
    SELECT source_id, count(*) AS n_errors, array_to_string(list_slice(list('word ' || idx || ': ' || error ORDER BY idx, c), 1, 20), '; ') AS errors FROM e GROUP BY source_id""")
def transcript_errors(spark, sf_dir):
    """The first twenty errors of every source's words, of many more."""
    return sequences.transcript_errors(tables.words(spark, sf_dir))


@query("file_fingerprints", """SELECT conv_id, sha256(t) AS sha256, CAST(strlen(t) AS BIGINT) AS size_bytes
    FROM (SELECT conv_id, CASE WHEN conv_id % 7 = 0 THEN '' ELSE string_agg(coalesce(text, ''), chr(10) ORDER BY turn) END AS t FROM conversations GROUP BY conv_id)""")
def file_fingerprints(spark, sf_dir):
    """Content hash and size of every file, read in chunks; some are empty."""
    out = files.fingerprint(spark, _written(spark, tables.conversation_files(spark, sf_dir)))
    return out.select(_number().alias("conv_id"), "sha256", "size_bytes")


@query("imported_documents", f"""SELECT source_id, passed, errors, 'external' AS tier, CASE WHEN passed THEN 'review-pending' ELSE 'failed' END AS status, 'kept' AS note FROM ({TRACK_ERRORS}) WHERE source_id % 17 <> 0""")
def imported_documents(spark, sf_dir):
    """Foreign manifest documents, read, validated and written anew; what they say then."""
    given = documents.read_documents(spark, _written(spark, tables.manifest_documents(*checked_crops(spark, sf_dir))), "manifest")
    own = documents.imported_documents(given, "2024-01-01T00:00:00Z")
    said = F.from_json("text", "tier string, status string, note string, validation struct<passed:boolean,errors:array<string>>")
    own = own.select(_number().alias("source_id"), said.alias("d"))
    return own.select("source_id", "d.validation.passed", F.array_join("d.validation.errors", "; ").alias("errors"), "d.tier", "d.status", "d.note")


@query("selection_counts", f"""WITH RECURSIVE {_CANDIDATES} SELECT source_id, coalesce(n, 0) AS n_selected, 5 AS n_requested, m - coalesce(n, 0) AS n_rejected
    FROM (SELECT source_id, count(*) AS m FROM c GROUP BY source_id) LEFT JOIN (SELECT source_id, count(*) AS n FROM p WHERE place <= 5 GROUP BY source_id) USING (source_id)""")
def selection_counts(spark, sf_dir):
    return runs.selection_counts(ranking.rank(tables.candidates(spark, sf_dir)), 5)


@query("track_counts", f"""WITH {_WEAK}, n AS (SELECT source_id, count(*) AS n_frames, count(DISTINCT shot_id) AS n_shots FROM rec GROUP BY source_id), s AS (SELECT source_id, count(*) AS n_sampled FROM bs GROUP BY source_id), u AS (SELECT source_id, count(*) AS n_unresolved FROM r GROUP BY source_id)
    SELECT source_id, n_shots, n_sampled, n_frames, coalesce(n_unresolved, 0) AS n_unresolved FROM n JOIN s USING (source_id) LEFT JOIN u USING (source_id)""")
def track_counts(spark, sf_dir):
    """How many shots, samples, frames and unresolved ranges the report of a source counts."""
    stretches = _stretches(spark, sf_dir)
    return runs.track_counts(tables.track_shots(spark, sf_dir), tables.boxes(spark, sf_dir), stretches, tracks.weak_ranges(stretches, 0.3))
