"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Every labelled training text counts once for each hashed n-gram it holds; the
log of the smoothed ratio of the two classes' counts is the n-gram's weight r.
A text is the vector of its n-gram frequencies times r, and a logistic
regression is fitted on such vectors. Counts cover all labelled training
rows; the regression is fitted on a bounded sample of them, `FIT_ROWS` of each
class by hash order of doc_id.

n-grams are taken over the characters of the lower-cased text (A-Z) inside words with one
blank at each side, so they do not run across words. Null and empty texts have
no n-grams and score by the intercept. Rows whose label or doc_id is null
teach nothing; a doc_id with several labels counts with each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import _text
from tidemark.llm._store import scored, small_batches, small_side, unwrapped, wrapped

BITS = 18
SIZES = (3, 4, 5, 6)
FIT_ROWS = 1500
#: A log-count ratio counts if it is so many of its standard errors from none.
MIN_Z = 2.5
PARTS = 16
#: Tasks' sums are added up in so many groups first.
SALTS = 32
#: Bytes of text whose n-grams are held at a time: a character begins up to four of them, and each takes about 50 bytes while it is counted.
SLICE_BYTES = 1 << 18
#: Texts of the sample held against the weights at a time.
BLOCK = 500
#: Labels up to this number are broadcast (16 MB); beyond it Spark joins by shuffle.
SMALL_ROWS = 1_000_000
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_LOW[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, whether it is a blank, bounds by row) of the characters of UTF-8 texts; a value stands for the character's bytes."""
    low = _LOW[data]
    of_byte = (_text.byte_values() >> np.uint64(32)).astype(np.uint32)
    later = (data & 0xC0) == 0x80  # continues a character
    later[offsets[:-1][offsets[:-1] < len(data)]] = False
    at = np.flatnonzero(~later)
    value = of_byte[low[at]]
    more = np.append(later, False)
    longer = np.flatnonzero(more[at + 1])
    for k in range(1, 4):
        longer = longer[at[longer] + k < len(data)]
        longer = longer[later[at[longer] + k]]
        if not len(longer):
            break
        value[longer] = value[longer] * np.uint32(0x85EBCA6B) + of_byte[data[at[longer] + k]]
    return value, low[at] == 0x20, np.searchsorted(at, offsets)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-gram ids, row of each), repeats kept."""
    rows = len(offsets) - 1
    chars, is_blank, bounds = _characters(data, offsets)
    size = np.diff(bounds)
    # a blank before, between and after the rows
    at = np.arange(len(chars)) + np.repeat(np.arange(1, rows + 1), size)
    value = np.full(len(chars) + rows + 1, (_text.byte_values()[0x20] >> np.uint64(32)).astype(np.uint32))
    value[at] = chars
    blank = np.ones(len(value), dtype=bool)
    blank[at] = is_blank
    row = np.zeros(len(value), dtype=np.int32)
    row[at] = np.repeat(np.arange(rows, dtype=np.int32), size)
    ids, where = [], []
    run = np.zeros(len(value), dtype=np.uint32)
    bad = np.zeros(len(value), dtype=bool)  # a blank strictly inside
    for n in range(1, max(SIZES) + 1):
        k = len(value) - n + 1
        if k <= 0:
            break
        run = run[:k] * np.uint32(0x01000193) + value[n - 1 :]
        bad = bad[:k]
        if n > 2:
            bad = bad | blank[n - 2 : n - 2 + k]
        if n in SIZES:
            good = np.flatnonzero(~bad)
            h = run[good] * np.uint32(0x9E3779B1)
            ids.append((h >> np.uint32(32 - BITS)).astype(np.int32))
            where.append(row[good + 1])  # the second character is never a separator
    if not ids:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(ids), np.concatenate(where)


def _class_counts(batches):
    """Texts of each class that hold each n-gram, in parts of the id range, and the number of texts (part -1): sums of a task."""
    counts, texts, some = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64), None
    for batch in batches:
        label = batch.column(1).to_pylist()
        for first, end, data, offsets in _text.string_slices(batch, "text", SLICE_BYTES):
            ids, row = _grams(data, offsets)
            both = np.unique((row.astype(np.int64) << BITS) | ids)
            own = np.array(label[first:end])
            for c in (0, 1):
                counts[c] += np.bincount(both[own[both >> BITS] == c] & ((1 << BITS) - 1), minlength=1 << BITS)
                texts[c] += int((own == c).sum())
            if some is None and end > first:  # any number of the task's own
                some = int(offsets[-1] + texts.sum()) % SALTS
    for c in (0, 1) if texts.any() else ():
        parts = [(-1, texts[c : c + 1]), *((i, x) for i, x in enumerate(np.split(counts[c], PARTS)))]
        yield pa.RecordBatch.from_arrays([pa.array([c] * len(parts), pa.int64()), pa.array([i for i, _ in parts], pa.int64()), pa.array([some] * len(parts), pa.int64()), pa.array([x.tobytes() for _, x in parts], pa.binary())], names=["label", "part", "salt", "n"])


def _summed(batches, salted: bool):
    """Sums of arrays by (label, part) and, if `salted`, by salt; a task holds one array for each."""
    total: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for label, part, salt, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
            key, n = (label, part, salt if salted else 0), np.frombuffer(n, np.int64)
            total[key] = total[key] + n if key in total else n
    keys = list(total)
    yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.int64()) for i in range(3)), pa.array([total[k].tobytes() for k in keys], pa.binary())], names=["label", "part", "salt", "n"])


def class_counts(taught: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(texts of each class that hold each n-gram, texts of each class) over all rows (text, label)."""
    schema = "label long, part long, salt long, n binary"
    sums = taught.select("text", "label").mapInArrow(_class_counts, schema)
    for keys, salted in ((("label", "part", "salt"), True), (("label", "part"), False)):
        sums = sums.repartition(*keys).mapInArrow(lambda it, salted=salted: _summed(it, salted), schema)
    n, texts = np.zeros((2, 1 << BITS)), np.zeros(2)
    for label, part, _, own in sums.collect():  # two arrays of fixed size
        if part < 0:
            texts[label] = np.frombuffer(own, np.int64)[0]
        else:
            n[label][(at := part * (n.shape[1] // PARTS)) : at + n.shape[1] // PARTS] = np.frombuffer(own, np.int64)
    return n, texts


def log_count_ratios(n: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Naive Bayes log-count ratio of each n-gram; 0 where it is less than MIN_Z of its standard errors."""
    ratio = np.log((n[1] + 1) / (texts[1] + 2)) - np.log((n[0] + 1) / (texts[0] + 2))
    ratio[np.abs(ratio) < MIN_Z * np.sqrt(1 / (n[1] + 1) + 1 / (n[0] + 1))] = 0
    return ratio


def _vectors(batches, used):
    used = used.value
    for batch in batches:
        for first, end, data, offsets in _text.string_slices(batch, "text", SLICE_BYTES):
            ids, row = _grams(data, offsets)
            at = np.searchsorted(row[order := np.argsort(row, kind="stable")], np.arange(end - first + 1))
            out_ids, out_n = [], []
            for i in range(end - first):
                u, c = np.unique(ids[order[at[i] : at[i + 1]]], return_counts=True)
                telling = used[u]
                out_ids.append(u[telling].astype(np.int32).tobytes())
                out_n.append((c[telling] / max(1, c.sum())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, end - first), pa.array(out_ids, pa.binary()), pa.array(out_n, pa.binary())], names=["label", "ids", "share"])


def _fit(vectors: list, ratio: np.ndarray, steps: int = 120, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression by Adam on the whole sample at each step; classes weigh alike."""
    y = np.array([v[0] for v in vectors], dtype=np.float64)
    cols = [np.frombuffer(v[1], np.int32) for v in vectors]
    # entries of BLOCK texts at a time: (first row, rows, n-gram, row, value)
    blocks = []
    for at in range(0, len(cols), BLOCK):
        flat = np.concatenate(cols[at : at + BLOCK])
        share = np.concatenate([np.frombuffer(v[2], np.float32) for v in vectors[at : at + BLOCK]])
        row = np.repeat(np.arange(len(cols[at : at + BLOCK]), dtype=np.int32), [len(c) for c in cols[at : at + BLOCK]])
        blocks.append((at, len(cols[at : at + BLOCK]), flat, row, (share * ratio[flat] * 100.0).astype(np.float32)))
    del cols
    vectors.clear()
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    # start from naive Bayes itself: every scaled feature counts with weight 1
    w, b = np.ones(len(ratio)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        gw, gb = l2 * w, 0.0
        for at, rows, flat, row, x in blocks:
            own = slice(at, at + rows)
            z = np.bincount(row, x * w[flat], minlength=rows) + b
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own]) * weight[own]
            gw += np.bincount(flat, x * g[row], minlength=len(w))
            gb += g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, c = 1 - 0.9**t, 1 - 0.999**t
        w -= 0.05 * (m / a) / (np.sqrt(v / c) + 1e-8)
        b -= 0.05 * (mb / a) / (np.sqrt(vb / c) + 1e-8)
    return w * ratio * 100.0, b


class NgramModel:
    """Weight of each hashed n-gram's frequency, and the intercept."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights.astype(np.float32), float(intercept)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> NgramModel:
    """A model from documents (doc_id, text) and labels (doc_id, label 0 or 1)."""
    small_batches(docs.sparkSession)
    pairs = labels.where("doc_id is not null and label in (0, 1)").select("doc_id", F.col("label").cast("long").alias("label")).distinct()
    taught = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text")).join(small_side(pairs, SMALL_ROWS), "doc_id")
    n, texts = class_counts(taught)
    if not texts.all():  # one class only: nothing to tell apart
        return NgramModel(np.zeros(1 << BITS), 0.0 if not texts.any() else 4.0 if texts[1] else -4.0)
    ratio = log_count_ratios(n, texts)
    used = docs.sparkSession.sparkContext.broadcast(ratio != 0)
    parts = []
    for c in (0, 1):
        least = pairs.where(F.col("label") == c).select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        own = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(least), "doc_id").select("text", "label")
        parts += own.mapInArrow(lambda it: _vectors(it, used), "label long, ids binary, share binary").collect()
    return NgramModel(*_fit(parts, ratio)) if parts else NgramModel(np.zeros(1 << BITS), 0.0)


def _scores(batches, model):
    m: NgramModel = model.value
    for batch in batches:
        z = np.full(batch.num_rows, m.intercept)
        for first, end, data, offsets in _text.string_slices(batch, "text", SLICE_BYTES):
            ids, row = _grams(data, offsets)
            total = np.bincount(row, minlength=end - first)
            z[first:end] += np.bincount(row, m.weights[ids], minlength=end - first) / np.maximum(total, 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["__rest", "__score"])


def score(docs: DataFrame, model: NgramModel, name: str = "score") -> DataFrame:
    """`docs` with a column `name`, in place of one that they may have: the chance that the text's label is 1."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return scored(docs, lambda it: _scores(it, sent), name, text=F.col("text").cast("string"))


def without_toxic(docs: DataFrame, model: NgramModel, at_least: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns kept, whose score is below `at_least`."""
    return unwrapped(score(wrapped(docs, "text"), model, "__score").where(F.col("__score") < at_least), docs.columns, "text")
