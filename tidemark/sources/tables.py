"""Logical inputs (candidates, words, detections) read from the driver's tables by integer arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored half-open frame ranges, many sources: source_id, id (some have none), fps, start_frame, end_frame, topic_key, flags, five scores (some lack one)."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - 1704067200000000
    start = F.floor(micros / 24_000_000).cast("long")
    scores = [(F.col("event_id") * k % 103 / 10).cast("decimal(4,1)").alias(n) for n, k in zip(("hook", "self_contained", "emotion", "payoff", "retention"), (7, 11, 13, 17, 19))]
    flags = F.when(F.col("event_id") % 11 == 0, F.array(F.lit("midSentence"))).otherwise(F.array().cast("array<string>"))
    scores[2] = F.when(F.col("event_id") % 29 != 0, scores[2]).alias("emotion")  # some candidates lack a score
    fps = F.when(F.col("user_id") % 4 == 1, 60.0).otherwise(30.0).alias("fps")
    given = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("clip"), F.col("event_id").cast("string"))).otherwise("").alias("id")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), "event_id", given, fps, start.alias("start_frame"), (start + 450 + F.col("event_id") * 37 % 1500).alias("end_frame"), F.col("event_type").alias("topic_key"), flags.alias("flags"), *scores)


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed words, many sources: source_id, idx, word, start_ms, end_ms. Some are out of order or empty in time."""
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.expr(r"regexp_extract_all(text, '[^ \\t\\n\\r]+', 0)")).alias("pos", "word"))
    idx = (F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "pos")) - 1).cast("long")
    own = own.select(F.col("conv_id").alias("source_id"), idx.alias("idx"), "turn", "word")
    start = F.col("idx") * 400 + F.col("turn") * 1000 - F.when(F.col("idx") % 17 == 5, 900).otherwise(0)
    return own.select("source_id", "idx", "word", start.alias("start_ms"), (start + F.when(F.col("idx") % 17 == 11, 0).otherwise(320)).alias("end_ms"))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions on a coarse frame grid, many sources: source_id, frame, shot_id, cx (null: nothing found), confidence. One row per frame."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - 1704067200000000
    frame = F.floor(micros / 1_200_000_000).cast("long")
    first = F.row_number().over(W.partitionBy("user_id", "frame").orderBy("event_id"))
    own = table(spark, sf_dir, "events").withColumn("frame", frame).withColumn("k", first).where("k = 1")
    cx = F.when(F.col("event_type") != "error", F.floor(F.col("value") * 16).cast("long") % 1920)
    return own.select(F.col("user_id").alias("source_id"), "frame", F.floor(F.col("frame") / 240).alias("shot_id"), cx.alias("cx"), (F.col("event_id") % 100).alias("confidence"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections on a coarse frame grid, many sources: source_id, frame, shot_id, x0, y0, x1, y1 (null: nothing found), confidence, detector. One row per frame."""
    own = table(spark, sf_dir, "events").withColumn("frame", F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - 1704067200000000) / 4_800_000_000).cast("long"))
    first = F.row_number().over(W.partitionBy("user_id", "frame").orderBy("event_id"))
    own = own.withColumn("k", first).where("k = 1")
    e, found = F.col("event_id"), F.col("event_type") != "error"
    x, y = F.floor(F.col("value") * 16).cast("long") % 1700, e % 700
    detector = F.get(F.array(F.lit("yolo"), F.lit("hog"), F.lit("haar")), (e % 3).cast("int"))
    corner = lambda v, name: F.when(found, v).alias(name)
    return own.select(F.col("user_id").alias("source_id"), "frame", F.floor(F.col("frame") / 240).alias("shot_id"), corner(x, "x0"), corner(y, "y0"), corner(x + 60 + e % 91, "x1"), corner(y + 100 + e % 281, "y1"), ((e % 100) / 100.0).alias("confidence"), detector.alias("detector"))


def track_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, shot_id, start_frame, end_frame): shots of 240 frames up to the last detection of a source."""
    frame = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - 1704067200000000) / 4_800_000_000).cast("long")
    own = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("source_id")).agg((F.max(frame) + 1).alias("total"))
    own = own.select("source_id", "total", F.explode(F.expr("sequence(0L, (total - 1) div 240)")).alias("shot_id"))
    return own.select("source_id", "shot_id", (F.col("shot_id") * 240).alias("start_frame"), F.least((F.col("shot_id") + 1) * 240, F.col("total")).alias("end_frame"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of scene-change logs, many sources: source_id, line_no, line. Views give a time (every 50th is unreadable), clicks fire, the rest is chatter."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - 1704067200000000
    ms = F.floor(micros / 1_000_000).cast("long")
    time = F.format_string("[scene @ 0x1] n:1 pts_time:%d.%03d ", F.floor(ms / 1000), ms % 1000)
    bad = F.lit("[scene @ 0x1] n:1 pts_time:N/A")
    line = F.when(F.col("event_type") == "view", F.when(F.col("event_id") % 50 == 0, bad).otherwise(time)).when(F.col("event_type") == "click", "lavfi.scene_score=0.5").otherwise("frame= 10 fps=0.0")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), F.col("event_id").alias("line_no"), line.alias("line"))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, total): frames of every source on the scene logs' grid."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - 1704067200000000
    frame = F.floor(F.floor(micros / 1_000_000) * 25 / 1000).cast("long")
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("source_id")).agg((F.max(frame) - 40).alias("total")).where("total > 0")


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered media and what was expected of them, one a part."""
    k = F.col("p_partkey")
    pick = lambda n, *v: F.get(F.array(*(F.lit(x) for x in v)), (k % n).cast("int"))
    return table(spark, sf_dir, "part").select(
        k.alias("media_id"), pick(3, 1080, 720, 1920).alias("width"), pick(3, 1920, 1280, 1080).alias("height"), pick(5, "30000/1001", "30/1", "0/0", "junk", "25").alias("rate"), (k * 7 % 1000).cast("long").alias("frames"),
        pick(4, 1080, 1080, 0, 1080).alias("want_width"), pick(4, 1920, 1920, 1920, 1920).alias("want_height"), pick(7, 30.0, 29.97, 0.0, 25.0, 30.0, 30.0, 30.0).alias("want_fps"), (k * 7 % 1000 + k % 4 - 1).cast("long").alias("want_frames"),
        (k % 211 / 10).alias("duration"), (k % 19 != 0).alias("has_video"), (k % 7 != 0).alias("has_audio"),
    ).withColumn("streams", F.array_compact(F.array(F.when(F.col("has_video"), F.struct(F.lit("video").alias("codec_type"), F.lit("h264").alias("codec_name"))), F.when(F.col("has_audio"), F.struct(F.lit("audio").alias("codec_type"), F.lit("aac").alias("codec_name"))))))


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(media_id, has_audio, duration and logs): what tools printed about levels, loudness, edges, still stretches and decoding; some of it can't be read."""
    k = F.col("p_partkey")
    text = lambda v: F.concat(F.lit("-"), v.cast("string"))
    volume = lambda v, bad: F.when(k % bad != 0, F.concat(F.lit("[parsed] n_samples: 9\n[parsed] mean_volume: "), text(v), F.lit(".5 dB\n"))).otherwise("[parsed] no samples\n")
    block = F.concat(F.lit('{\n "input_i" : "'), text(k % 30), F.lit('.25",\n "input_tp" : "'), text(k % 3), F.lit(".50"), F.lit('"\n}\n'))
    loudness = F.when(k % 23 == 0, "nothing\n").when(k % 29 == 0, F.lit('{"input_i" : broken}\n')).otherwise(F.concat(F.lit('{ "input_i" : "-99.0", "input_tp" : "9.0" }\nlater\n'), block))
    freeze = F.repeat(F.lit("[freeze] freeze_start: 1.5\n"), (k % 4).cast("int"))
    decode = F.concat(F.repeat(F.lit("broken packet\n"), (k % 3).cast("int")), F.lit(" \n"))
    return table(spark, sf_dir, "part").select(
        k.alias("media_id"), (k % 7 != 0).alias("has_audio"), (k % 211 / 10).alias("duration"), volume(k % 70, 13).alias("audio_log"), volume(k * 3 % 90, 17).alias("head_log"), volume(k * 7 % 90, 31).alias("tail_log"),
        loudness.alias("loudness_log"), freeze.alias("freeze_log"), decode.alias("decode_log"),
    )


def media_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(media_id, log): texts with none to seven black stretches."""
    k = F.col("p_partkey")
    one = lambda i: F.concat(F.lit("[black @ 1] black_start:"), (k % 3 + i).cast("string"), F.lit(".25 black_end:"), (k % 3 + i + 1).cast("string"), F.lit("\n"))
    return table(spark, sf_dir, "part").select(k.alias("media_id"), F.concat(F.lit("ffmpeg\n"), *(F.when(k % 8 > i, one(i)).otherwise("") for i in range(7))).alias("log"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, clip, contract_id): the clips of every run."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("clip"), F.col("l_partkey").alias("contract_id"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contract_id, file_id, sha)."""
    return table(spark, sf_dir, "part").where("p_size % 7 <> 0").select(F.col("p_partkey").alias("contract_id"), (F.col("p_partkey") * 3 % 5000).alias("file_id"), (F.col("p_partkey") % 4).cast("string").alias("sha"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, sha): files as they are now."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("file_id"), (F.col("c_custkey") * 7 % 4).cast("string").alias("sha"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, seq, action): the log of every run's review."""
    action = F.when(F.col("event_type") == "signup", "plan").when(F.col("event_type") == "purchase", "plan-uncertain").when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "click", "accept").when(F.col("event_id") % 2 == 0, "approve").otherwise("publish")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), action.alias("action"))


def transcript_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, text): a transcript document of every source of words(), times in seconds; every eleventh is cut off, every thirteenth empty."""
    word = F.struct("idx", F.struct("word", (F.col("start_ms") / 1000.0).alias("start"), (F.col("end_ms") / 1000.0).alias("end")).alias("w"))
    own = words(spark, sf_dir).groupBy("source_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(word)), lambda x: x["w"])).alias("text"))
    text = F.when(F.col("source_id") % 13 == 0, "").when(F.col("source_id") % 11 == 0, F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return own.select(F.format_string("%d.json", "source_id").alias("file"), text.alias("text"))


def conversation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, text): the texts of every conversation by turn; every seventh is empty."""
    own = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    text = F.when(F.col("conv_id") % 7 == 0, "").otherwise(F.array_join(F.transform("turns", lambda x: F.coalesce(x["text"], F.lit(""))), "\n"))
    return own.select(F.format_string("%d.txt", "conv_id").alias("file"), text.alias("text"))


def manifest_documents(crops: DataFrame, videos: DataFrame) -> DataFrame:
    """(file, text): a foreign manifest document of every source's crops (source_id, frame, x, y, width, height) and video (source_id, w, h, total); it says that it is ready. Every seventeenth lacks its output."""
    frame = F.struct("frame", F.struct("x", "y", "width", "height").alias("crop"))
    own = crops.groupBy("source_id").agg(F.array_sort(F.collect_list(frame)).alias("frames")).join(videos, "source_id")
    output = F.when(F.col("source_id") % 17 != 0, F.struct(F.lit(1080).alias("width"), F.lit(1920).alias("height")))
    document = F.struct(
        F.struct(F.lit("a.mp4").alias("path"), F.lit("00").alias("sha256")).alias("source"), F.struct(F.col("w").alias("width"), F.col("h").alias("height"), F.col("total").alias("totalFrames")).alias("video"),
        output.alias("output"), F.lit("ready").alias("status"), F.lit("kept").alias("note"), "frames",
    )
    return own.select(F.format_string("%d.json", "source_id").alias("file"), F.to_json(document).alias("text"))
