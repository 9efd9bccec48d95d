"""Files of any store: listed by tasks, read in bounded chunks, and written whole or not at all."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a task reads at a time.
CHUNK = 4 << 20


def _roots(spark: SparkSession, path: str) -> list[str]:
    """What a path or pattern names, as scheme://authority/path of the store that holds it: Hadoop resolves names of other stores."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    given = jvm.org.apache.hadoop.fs.Path(path)
    store = given.getFileSystem(conf)
    found = store.globStatus(given)
    if not found:
        raise FileNotFoundError(path)
    uris = [store.resolvePath(status.getPath()).toUri() for status in found]
    return [f"{u.getScheme() or 'file'}://{u.getAuthority() or ''}{u.getPath()}" for u in uris]


def opened(file: str) -> tuple[stores.FileSystem, str]:
    """The store of scheme://authority/path, and the path in it."""
    scheme, _, rest = file.partition("://")
    if scheme == "file":
        return stores.LocalFileSystem(), rest
    authority, _, path = rest.partition("/")
    store, base = stores.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{authority}/")
    return store, f"{base.rstrip('/')}/{path}"


def _entries(folder: str, deep: bool):
    """(file, size, folder?) of what a folder holds, or of a file itself; names that begin with _ or . are left out."""
    store, path = opened(folder)
    own = store.get_file_info(path)
    if own.type == stores.FileType.File:
        yield folder, own.size, False
        return
    top = len(path.rstrip("/"))
    for x in store.get_file_info(stores.FileSelector(path, recursive=deep)):
        if any(part[:1] in "_." for part in x.path[top:].strip("/").split("/")):
            continue
        yield folder.rstrip("/") + x.path[top:], x.size or 0, x.type == stores.FileType.Directory


_LISTED = "file string, size_bytes long, folder boolean"


def _lister(deep: bool):
    def kernel(batches):
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                rows = list(_entries(folder, deep))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.bool_()))], names=["file", "size_bytes", "folder"])

    return kernel


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, size_bytes) of every file under a path, those without content too: the folders of the first level are listed side by side.

    Names that begin with _ or . are left out, as Spark leaves them out. A missing path is an error.
    """
    roots = spark.createDataFrame([(r,) for r in _roots(spark, path)], "file string").repartition(spark.sparkContext.defaultParallelism, "file")
    first = roots.mapInArrow(_lister(False), _LISTED)
    below = first.where("folder").select("file").repartition(spark.sparkContext.defaultParallelism, "file").mapInArrow(_lister(True), _LISTED)
    return first.unionByName(below).where("not folder").drop("folder")


def _spread(files: DataFrame, tasks: int | None) -> DataFrame:
    return files.repartition(tasks or 4 * files.sparkSession.sparkContext.defaultParallelism, "file")


def fingerprint(spark: SparkSession, path: str, chunk: int = CHUNK, tasks: int | None = None) -> DataFrame:
    """(file, sha256, size_bytes, error) of every file under a path.

    A task holds `chunk` bytes of a file, however large it is; size_bytes are those that were read. A file that can't be
    read is a row with its error and no hash.
    """

    def kernel(batches):
        for batch in batches:
            out = []
            for file in batch.column(0).to_pylist():
                digest, size = hashlib.sha256(), 0
                try:
                    store, place = opened(file)
                    with store.open_input_stream(place, buffer_size=0) as stream:
                        while part := stream.read(chunk):
                            digest.update(part)
                            size += len(part)
                    out.append((file, digest.hexdigest(), size, None))
                except OSError as e:
                    out.append((file, None, None, f"cannot be read: {type(e).__name__}"))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))], names=["file", "sha256", "size_bytes", "error"])

    return _spread(list_files(spark, path).select("file"), tasks).mapInArrow(kernel, "file string, sha256 string, size_bytes long, error string")


def read_texts(spark: SparkSession, path: str, most: int = 64 << 20, tasks: int | None = None, check: Callable[[str], str | None] = lambda text: None) -> DataFrame:
    """(file, text, error) of every file under a path: its text, or why there is none (empty, over `most` bytes, not UTF-8, can't be read, or what `check` says of it)."""

    def text_of(file: str) -> tuple[str | None, str | None]:
        try:
            store, place = opened(file)
            with store.open_input_stream(place) as stream:
                data = stream.read(most + 1)
            if len(data) > most:
                return None, f"over {most} bytes"
            text = data.decode()
            error = check(text) if text else "empty file"
            return (None, error) if error else (text, None)
        except UnicodeDecodeError:
            return None, "not UTF-8"
        except OSError as e:
            return None, f"cannot be read: {type(e).__name__}"

    def kernel(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():  # one document at a time
                text, error = text_of(file)
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (file, text, error)], names=["file", "text", "error"])

    return _spread(list_files(spark, path).select("file"), tasks).mapInArrow(kernel, "file string, text string, error string")


def write_texts(documents: DataFrame, folder: str | None = None) -> int:
    """Writes documents (file, text) at their places, or under their last names in `folder`; how many.

    A document is written beside its place and then moved there, so a reader sees the old one or the new one, and a task
    that runs twice does no harm. Of repeated places one document wins.
    """
    rows = documents.select("file", "text")
    if folder is not None:
        spark = documents.sparkSession
        jvm = spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(folder)
        store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        store.mkdirs(place)
        root = _roots(spark, folder)[0]
        rows = rows.select(F.concat(F.lit(root.rstrip("/") + "/"), F.substring_index("file", "/", -1)).alias("file"), "text")

    def kernel(batches):
        for batch in batches:
            for file, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, place = opened(file)
                beside = f"{place}.{uuid.uuid4().hex}.tmp"
                with store.open_output_stream(beside) as stream:
                    stream.write((text or "").encode())
                os.replace(beside, place) if isinstance(store, stores.LocalFileSystem) else store.move(beside, place)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return rows.mapInArrow(kernel, "n long").agg(F.sum("n")).first()[0] or 0


def scratch_folder(spark: SparkSession) -> str:
    """A new place in the folder that spark.checkpoint.dir names for the driver and all executors; a temporary one where it is unset and Spark runs in one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/tidemark-files/{uuid.uuid4().hex}"
