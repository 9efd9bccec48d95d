"""JSON documents: typed readers that set unreadable ones aside, tables made of them, canonical and atomic writing."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tidemark.functions.scalar import SCORE_NAMES
from tidemark.operators import runs, tracks
from tidemark.sources import files

#: The fields of each kind of document.
CANDIDATE = "id string, startFrame long, endFrameExclusive long, topicKey string, scores map<string,double>, rejectionFlags array<string>"
KINDS = {
    "candidates": f"array<struct<{CANDIDATE.replace(' ', ':').replace(',:', ',')}>>",
    "transcript": "array<struct<word:string,start:double,end:double>>",
    "contract": (
        "struct<id:string,rank:int,source:struct<parentPath:string,parentSha256:string,sourceRange:struct<startFrame:bigint,endFrameExclusive:bigint>,materializedPath:string,materializedFingerprint:struct<path:string,sha256:string,sizeBytes:bigint>>,"
        "timeline:struct<startFrame:bigint,endFrameExclusive:bigint,fps:double,width:int,height:int,totalFrames:bigint,materialized:struct<width:int,height:int,fps:double,totalFrames:bigint>>,"
        "selection:struct<scores:map<string,double>,composite:double,topicKey:string,hookText:string,suggestedTitle:string>>"
    ),
    "manifest": (
        "struct<source:struct<path:string,sha256:string,sizeBytes:bigint>,video:struct<width:int,height:int,fps:double,totalFrames:bigint>,output:struct<width:int,height:int>,status:string,tier:string,"
        "frames:array<struct<frame:bigint,crop:struct<x:double,y:double,width:double,height:double>,confidence:double,flags:array<string>>>>"
    ),
}
#: Fields without which a document is none of its kind.
NEEDED = {"contract": ("id", "timeline"), "manifest": ("source", "output.width", "output.height")}


def _json_error(text: str) -> str | None:
    try:
        json.loads(text)
    except (ValueError, RecursionError) as e:
        return f"not JSON: {str(e)[:80]}"
    return None


def read_documents(spark: SparkSession, path: str, kind: str, most: int = 64 << 20) -> DataFrame:
    """(file, document, text, error) of every file under a path, of a kind named in KINDS.

    Nothing vanishes: a file that is empty, too large, not UTF-8, not JSON, or whose fields have other types or are
    lacking, is a row with its error and no document. Fields beyond the kind's are left in `text`. Candidates may lie in an
    object under `candidates`. A document is read whole by one task; many are spread.
    """
    texts = files.read_texts(spark, path, most, check=_json_error)
    held = KINDS[kind]
    parsed = lambda inner, options: F.from_json(F.concat(F.lit('{"d":'), "text", F.lit("}")), f"struct<d:{inner},__broken:string>", options)
    options = {"columnNameOfCorruptRecord": "__broken"}
    own = texts.withColumn("p", parsed(held, options))
    document, broken = F.col("p.d"), F.col("p.__broken").isNotNull()
    if kind == "candidates":
        own = own.withColumn("q", parsed(f"struct<candidates:{held}>", options))
        bare = F.ltrim(F.regexp_replace(F.substring("text", 1, 1000), r"\s", "")).startswith("[")
        document, broken = F.when(bare, document).otherwise(F.col("q.d.candidates")), F.when(bare, broken).otherwise(F.col("q.__broken").isNotNull())
    lacking = [F.when(document.getField(f.split(".")[0]).isNull() if "." not in f else document.getField(f.split(".")[0]).getField(f.split(".")[1]).isNull(), f"no field {f}") for f in NEEDED.get(kind, ())]
    error = F.coalesce("error", F.when(broken | document.isNull(), f"not a {kind}: a field has another type"), *lacking)
    return own.select("file", F.when(error.isNull(), document).alias("document"), "text", error.alias("error"))


def set_aside(documents: DataFrame) -> DataFrame:
    """(file, error) of the documents that could not be read."""
    return documents.where("error is not null").select("file", "error")


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per candidate of candidate documents, with the file it came from; see read_documents() for those that are none."""
    items = read_documents(spark, path, "candidates").select("file", F.posexplode("document").alias("idx", "c"))
    return items.where("c is not null").select("file", "idx", "c.*")


def words_of(transcripts: DataFrame) -> DataFrame:
    """(source_id, idx, word, start_ms, end_ms) of transcript documents, a source a file; times that are no finite numbers are null."""
    ms = lambda c: F.when(F.abs(F.col(c)) < F.lit(1e15), F.round(F.col(c) * 1000).cast("long"))
    own = transcripts.select(F.col("file").alias("source_id"), F.posexplode("document").alias("at", "w"))
    return own.select("source_id", F.col("at").cast("long").alias("idx"), "w.word", ms("w.start").alias("start_ms"), ms("w.end").alias("end_ms"))


def crops_of(manifests: DataFrame) -> DataFrame:
    """(source_id, frame, x, y, width, height) of the frames of manifest documents, a source a file."""
    own = manifests.select(F.col("file").alias("source_id"), F.explode("document.frames").alias("f"))
    return own.select("source_id", "f.frame", "f.crop.x", "f.crop.y", "f.crop.width", "f.crop.height")


def videos_of(manifests: DataFrame) -> DataFrame:
    """(source_id, w, h, total, out_width, out_height): what manifest documents say of their video and output."""
    return manifests.where("document is not null").select(F.col("file").alias("source_id"), F.col("document.video.width").alias("w"), F.col("document.video.height").alias("h"), F.col("document.video.totalFrames").alias("total"), F.col("document.output.width").alias("out_width"), F.col("document.output.height").alias("out_height"))


def imported_documents(manifests: DataFrame, now: str, videos: DataFrame | None = None) -> DataFrame:
    """(file, passed, errors, status, text) of foreign manifest documents: validated anew, and their text with that, tier external and the status that follows.

    `videos` (source_id, w, h, total) are probed ones; else what the documents say of their video counts. All other fields
    of a document stay. The text has its keys in order, so it can be written back by files.write_texts().
    """
    own = videos_of(manifests)
    if videos is not None:
        own = own.drop("w", "h", "total").join(videos, "source_id")
    judged = runs.imported(tracks.track_errors(crops_of(manifests), own)).withColumnRenamed("source_id", "file")
    both = manifests.where("error is null").select("file", "text").join(judged, "file")

    def kernel(batches):
        for batch in batches:
            columns = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text", "passed", "errors", "status")}
            texts = []
            for text, passed, errors, status in zip(*columns.values()):
                own = json.loads(text)
                own |= {"validation": {"passed": passed, "errors": errors.split("; ") if errors else [], "checkedAt": now}, "tier": "external", "status": status, "updatedAt": now}
                texts.append(json.dumps(own, indent=2, sort_keys=True))
            yield batch.select(["file", "passed", "errors", "status"]).append_column("text", pa.array(texts, pa.string()))

    return both.select("file", "passed", "errors", "status", "text").mapInArrow(kernel, "file string, passed boolean, errors string, status string, text string")


def ranking_input(candidates: DataFrame, fps: float) -> DataFrame:
    """read_candidates() as operators/ranking.py takes them: one source a file, exact scores, ranges at `fps`."""
    score = lambda name: F.try_element_at("scores", F.lit(name)).cast("decimal(9,4)")
    flags = F.coalesce("rejectionFlags", F.array().cast("array<string>"))
    return candidates.select(F.col("file").alias("source_id"), F.col("idx").alias("event_id"), "id", F.lit(float(fps)).alias("fps"), F.col("startFrame").alias("start_frame"), F.col("endFrameExclusive").alias("end_frame"), F.col("topicKey").alias("topic_key"), flags.alias("flags"), *(score(name).alias(c) for c, name in SCORE_NAMES.items()))


def contract_documents(clips: DataFrame) -> DataFrame:
    """(source_id, id, document): the contract of every clip (source_id, id, rank, sha256, start_frame, end_frame, n_frames, fps, width, height, composite, topic_key) as a nested JSON text."""
    document = F.struct(
        F.lit(1).alias("schemaVersion"), F.lit("[startFrame,endFrameExclusive)").alias("rangeSemantics"), "id", "rank",
        F.struct(F.col("sha256").alias("parentSha256"), F.struct(F.col("start_frame").alias("startFrame"), F.col("end_frame").alias("endFrameExclusive")).alias("sourceRange")).alias("source"),
        F.struct(F.lit(0).alias("startFrame"), F.col("n_frames").alias("endFrameExclusive"), "fps", "width", "height").alias("timeline"),
        F.struct("composite", F.col("topic_key").alias("topicKey"), F.lit(None).cast("string").alias("hookText")).alias("selection"),
    )
    return clips.select("source_id", "id", F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))


def in_key_order(value: Column, kind: DataType) -> Column:
    """`value` with the fields of its structs and the keys of its maps in order, at every depth."""
    if isinstance(kind, StructType):
        fields = [in_key_order(value.getField(f.name), f.dataType).alias(f.name) for f in sorted(kind, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: in_key_order(x, kind.elementType))
    if isinstance(kind, MapType):
        keys = F.array_sort(F.map_keys(value))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: in_key_order(F.element_at(value, k), kind.valueType)))
    return value


def canonical_json(df: DataFrame) -> Column:
    """The rows of df as JSON texts: the same bytes for the same values, whatever the order of fields and keys; nulls are written."""
    fields = [in_key_order(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in sorted(df.schema, key=lambda f: f.name)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def write_json(df: DataFrame, path: str) -> None:
    """A canonical JSON line per row; fails if the path has anything, and shows all rows or none."""
    rows = df.select(canonical_json(df).alias("value"))
    rows.write.mode("errorifexists").text(path)


def write_script(lines: DataFrame, path: str) -> None:
    """Lines (source_id, frame, line) as text, a folder for each source, in frame order; line ends are LF."""
    own = lines.repartition("source_id").sortWithinPartitions("source_id", "frame").select("source_id", "line")
    own.write.mode("errorifexists").partitionBy("source_id").option("lineSep", "\n").text(path)


def to_publish(wanted: DataFrame, there: DataFrame) -> DataFrame:
    """The rows of `wanted` (name, sha256) that `there` lacks or holds with another content."""
    return wanted.join(there.select("name", "sha256"), ["name", "sha256"], "left_anti")
