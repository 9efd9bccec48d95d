"""Benchmark decontamination: short test items found inside long documents.

Texts are sets of hashed word shingles. An item is contained in a document when
at least `percent` of a hundred of its shingles occur there. Items are
partitioned by the size of their sets; in each partition the MinHash sketch of
an item is its k least shingle hashes, where k grows with the partition's
largest size so that a document with enough of the item's shingles must hold
one of the sketch (any `n - ceil(t * n) + 1` shingles must). Documents are
probed with the sketches, and what is found is verified by exact containment.

The items are the stated query set: they are read in blocks of bounded size,
each of which is broadcast and held against every document.

An item with fewer words than a shingle is its whole word sequence, looked for
as a run of that many words. Null or empty items and documents match nothing;
rows with a null id take no part; equal rows give one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm import _text
from tidemark.llm._store import kept, small_batches, small_side, unwrapped, wrapped

#: Shingles of the items held against the documents at a time (8 bytes each, with their item 12).
BLOCK_SHINGLES = 2_000_000
SMALL_ROWS = 1_000_000


def _item_sets(batches, size: int):
    for batch in batches:
        for first, end, data, offsets in _text.string_slices(batch, "text"):
            _, _, hashes, bounds = _text.words(data, offsets)
            runs, at = _text.shingles(hashes, bounds, size)
            out, lengths = [], []
            for i in range(end - first):
                n = int(bounds[i + 1] - bounds[i])
                lengths.append(min(n, size))
                if 0 < n < size:  # as a run of n words in a document
                    out.append(_text.shingles(hashes[bounds[i] : bounds[i + 1]], np.array([0, n]), n)[0])
                else:
                    out.append(np.unique(runs[at[i] : at[i + 1]]))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(lengths, pa.int64()), _text.long_array(out)], names=["item_id", "width", "shingles"])


def sketch_length(n: int, percent: int, ratio: float = 1.25) -> int:
    """Least hashes kept of an item of n shingles, by the largest size of its partition; partitions grow by `ratio`."""
    low = 1
    while True:
        high = max(low, int(low * ratio))
        if n <= high:
            return min(n, high - -(-percent * high // 100) + 1)
        low = high + 1


class _Block:
    """The shingles and sketches of a block of items, by width."""

    def __init__(self, rows: list, percent: int):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.size = np.array([len(r[2]) for r in rows], np.int64)
        self.widths = {}
        for width in sorted({r[1] for r in rows}):
            at = [i for i, r in enumerate(rows) if r[1] == width]
            sets = [np.sort(np.array(rows[i][2], np.int64).view(np.uint64)) for i in at]
            sketch = np.unique(np.concatenate([s[: sketch_length(len(s), percent)] for s in sets]))
            flat = np.concatenate(sets)
            item = np.repeat(at, [len(s) for s in sets])
            order = np.argsort(flat, kind="stable")
            self.widths[width] = sketch, _filter(sketch), flat[order], item[order]


FILTER_BITS = 22


def _filter(sketch: np.ndarray) -> np.ndarray:
    """One flag for each leading-bits value that a sketch holds: most shingles of a document end here."""
    flags = np.zeros(1 << FILTER_BITS, dtype=bool)
    flags[(sketch >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return flags


def _member(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


def _search(batches, block, percent: int):
    b: _Block = block.value
    for batch in batches:
        found: list[tuple] = []
        for first, end, data, offsets in _text.string_slices(batch, "text"):
            _, _, hashes, bounds = _text.words(data, offsets)
            for width, (sketch, flags, flat, item) in b.widths.items():
                runs, at = _text.shingles(hashes, bounds, width, whole=False)
                hit = np.flatnonzero(flags[(runs >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
                hit = hit[_member(sketch, runs[hit])]
                for i in np.unique(np.searchsorted(at, hit, side="right") - 1):  # candidates; then the exact containment
                    own = np.unique(runs[at[i] : at[i + 1]])
                    left, right = np.searchsorted(flat, own), np.searchsorted(flat, own, side="right")
                    n = right - left
                    where = np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    which, count = np.unique(item[where], return_counts=True)
                    for k, c in zip(which, count):
                        if 100 * c >= percent * b.size[k]:
                            found.append((first + int(i), int(b.ids[k]), int(b.size[k]), int(c)))
        rows, ids, size, count = zip(*found) if found else ([], [], [], [])
        doc = batch.column(0).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([doc, *(pa.array(x, pa.int64()) for x in (ids, size, count))], names=["doc_id", "item_id", "n_shingles", "n_found"])


def contained_items(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 80, block: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found): the items (item_id, text) contained in documents (doc_id, text)."""
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _contained(docs, items, size, percent, block)


def _contained(docs: DataFrame, items: DataFrame, size: int, percent: int, block: int) -> DataFrame:
    """The items contained in documents whose first column, doc_id, may be of any type."""
    spark = docs.sparkSession
    small_batches(spark)
    made = StructType([docs.schema["doc_id"], *(StructField(c, LongType()) for c in ("item_id", "n_shingles", "n_found"))])
    items = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    sets = items.mapInArrow(lambda it: _item_sets(it, size), "item_id long, width long, shingles array<long>").where("size(shingles) > 0").distinct()
    sets = kept(sets)
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    blocks = max(1, -(-total // block))
    out = None
    for i in range(blocks):
        own = sets if blocks == 1 else sets.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == i)
        rows = own.collect()  # one block of the query set
        if not rows:
            continue
        sent = spark.sparkContext.broadcast(_Block(rows, percent))
        found = docs.mapInArrow(lambda it, sent=sent: _search(it, sent, percent), made)
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], made)
    return out.distinct()


def without_items(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns kept, whose text has no contained item. Rows of one doc_id are judged each by its own text; those without an id stay."""
    key = lambda doc_id, text: F.struct(doc_id.cast("long").alias("doc_id"), F.xxhash64(text.cast("string")).alias("h"))
    given = docs.where("doc_id is not null").select(key(F.col("doc_id"), F.col("text")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    hit = kept(_contained(given, items, size, percent, BLOCK_SHINGLES).select("doc_id.*").distinct().toDF("__hit", "__h"))
    own = wrapped(docs, "doc_id", "text")
    left = own.join(small_side(hit, SMALL_ROWS), (own["doc_id"].cast("long") == F.col("__hit")) & (F.xxhash64(own["text"].cast("string")) == F.col("__h")), "left_anti")
    return unwrapped(left, docs.columns, "doc_id", "text")
