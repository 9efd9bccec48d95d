"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector: the frequency of each hashed word, dense statistics
of its structure (how upper-case, symbol-ridden, repetitive, long-worded,
line-broken it is) and its declared length beside its real one. The machine scores

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)

so all pairwise interactions cost one pass (the sum-of-squares identity). It
is fitted on a bounded sample of the labelled training rows, `FIT_ROWS` of each class
by hash order of doc_id; mean and spread of the statistics are those of all training rows.

Null and empty texts have no words and are scored by their statistics. A null
n_chars counts as 0. Rows whose label or doc_id is null teach nothing; a doc_id
with several labels counts with each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import _text
from tidemark.llm._store import scored, small_batches

BITS = 16
RANK = 6
FIT_ROWS = 2000
STEPS = 150
N_DENSE = 16


def _class_of_bytes() -> np.ndarray:
    kind = np.full(256, 5, np.int8)  # 5: part of a longer character
    kind[:128] = 4  # symbols
    kind[list(b" \t\n\r\x0b\x0c")] = 0
    kind[97:123], kind[65:91], kind[48:58] = 1, 2, 3
    kind[list(b".,;:'-?")] = 6
    return kind


_KIND = _class_of_bytes()


def features(data: np.ndarray, offsets: np.ndarray, declared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(dense statistics by row, then of the distinct words: row, id, frequency)."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(rows), size)
    kinds = np.bincount(row * 7 + _KIND[data], minlength=rows * 7).reshape(rows, 7)
    starts, ends, hashes, bounds = _text.words(data, offsets)
    n = np.diff(bounds)
    of = np.repeat(np.arange(rows), n)
    ids = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    keys, count = np.unique((of << BITS) | ids, return_counts=True)
    word_row, word_id = keys >> BITS, keys & ((1 << BITS) - 1)
    distinct = np.bincount(word_row, minlength=rows)
    full, chars = np.maximum(n, 1), np.maximum(size, 1)
    length = ends - starts
    last = _KIND[data[ends - 1]] if len(ends) else np.zeros(0, np.int8)
    first = _KIND[data[starts]] if len(starts) else np.zeros(0, np.int8)
    same = np.zeros(len(ids), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    lines = np.bincount(row[data == 10], minlength=rows)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2] + kinds[:, 5], 1)
    real = size - np.bincount(row[(data & 0xC0) == 0x80], minlength=rows)
    by = lambda x: np.bincount(of, x, minlength=rows)
    dense = np.stack([
        np.log1p(n), by(length) / full, by(length.astype(float) ** 2) / full / 50, distinct / full, by(same) / full,
        by(last == 4) / full, by(first == 4) / full, by((length == 1) & (last == 4)) / full, kinds[:, 2] / letters, kinds[:, 3] / chars,
        kinds[:, 4] / chars, kinds[:, 6] / chars, lines / full, np.bincount(word_row, count.astype(float) ** 2, minlength=rows) / full**2,
        np.log1p(np.maximum(declared, 0)), np.minimum(np.abs(declared - real) / np.maximum(real, 1), 5),
    ], axis=1)
    return dense, word_row, word_id, count / full[word_row]


class Machine:
    """Weights of words and of dense statistics, their factors, and the scaling of the statistics."""

    def __init__(self, words: int = 1 << BITS, seed: int = 7):
        r = np.random.default_rng(seed)
        self.w0, self.w, self.v = 0.0, np.zeros(words + N_DENSE), r.normal(0, 0.02, (words + N_DENSE, RANK))
        self.mean, self.spread = np.zeros(N_DENSE), np.ones(N_DENSE)

    def scaled(self, dense: np.ndarray) -> np.ndarray:
        return np.clip((dense - self.mean) / self.spread, -4, 4) / 4

    def margin(self, dense: np.ndarray, row: np.ndarray, word: np.ndarray, share: np.ndarray) -> np.ndarray:
        d, rows, k = self.scaled(dense), len(dense), len(self.w) - N_DENSE
        z = self.w0 + d @ self.w[k:] + np.bincount(row, share * self.w[word], minlength=rows)
        for f in range(RANK):
            x = share * self.v[word, f]
            total = np.bincount(row, x, minlength=rows) + d @ self.v[k:, f]
            square = np.bincount(row, x * x, minlength=rows) + (d * d) @ (self.v[k:, f] ** 2)
            z = z + 0.5 * (total * total - square)
        return z

    def fit(self, dense, row, word, share, y, steps: int = STEPS, rate: float = 0.03, l2: float = 1e-4, scale: tuple | None = None) -> Machine:
        """Adam on the logistic loss of the whole sample; classes weigh alike. `scale` is (mean, spread) of the statistics, else the sample's."""
        self.mean, self.spread = scale or (dense.mean(0), dense.std(0) + 1e-6)
        d, rows, k = self.scaled(dense), len(dense), len(self.w) - N_DENSE
        weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
        used = np.unique(word)
        local = np.searchsorted(used, word)
        at = np.concatenate([used, np.arange(k, k + N_DENSE)])
        p = np.concatenate([self.w[at, None], self.v[at]], axis=1)
        m, s, bias, mb, sb = np.zeros_like(p), np.zeros_like(p), 0.0, 0.0, 0.0
        n = len(used)
        for t in range(1, steps + 1):
            z = bias + d @ p[n:, 0] + np.bincount(row, share * p[local, 0], minlength=rows)
            totals = []
            for f in range(1, RANK + 1):
                x = share * p[local, f]
                total = np.bincount(row, x, minlength=rows) + d @ p[n:, f]
                z = z + 0.5 * (total * total - np.bincount(row, x * x, minlength=rows) - (d * d) @ (p[n:, f] ** 2))
                totals.append(total)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
            grad = l2 * p
            gr = g[row]
            grad[:n, 0] += np.bincount(local, share * gr, minlength=n)
            grad[n:, 0] += d.T @ g
            pull = share * share * gr
            own = np.bincount(local, pull, minlength=n)
            own_dense = (d * d).T @ g
            for f, total in enumerate(totals, 1):
                grad[:n, f] += np.bincount(local, share * gr * total[row], minlength=n) - own * p[:n, f]
                grad[n:, f] += d.T @ (g * total) - own_dense * p[n:, f]
            gb = g.sum()
            m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad * grad
            mb, sb = 0.9 * mb + 0.1 * gb, 0.999 * sb + 0.001 * gb * gb
            a, c = 1 - 0.9**t, 1 - 0.999**t
            p = p - rate * (m / a) / (np.sqrt(s / c) + 1e-8)
            bias -= rate * (mb / a) / (np.sqrt(sb / c) + 1e-8)
        self.w0 = float(bias)
        self.w[at], self.v[at] = p[:, 0], p[:, 1:]
        rest = np.ones(k, bool)
        rest[used] = False
        self.v[:k][rest] = 0  # words that the sample does not hold say nothing
        return self


def _rows(batches):
    for batch in batches:
        declared = np.array(batch.column(1).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.float64)
        for first, end, data, offsets in _text.string_slices(batch, "text"):
            dense, row, word, share = features(data, offsets, declared[first:end])
            at = np.searchsorted(row, np.arange(end - first + 1))
            cut = lambda x, kind: pa.array([x[at[i] : at[i + 1]].astype(kind).tobytes() for i in range(end - first)], pa.binary())  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([batch.column(2).slice(first, end - first), pa.array([r.tobytes() for r in dense], pa.binary()), cut(word, np.int32), cut(share, np.float32)], names=["label", "dense", "words", "share"])


def _sums(batches):
    """(at, n, s, ss): for each statistic the rows, sum and sum of squares of a task."""
    n, s, ss = 0, np.zeros(N_DENSE), np.zeros(N_DENSE)
    for batch in batches:
        declared = np.array(batch.column(1).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.float64)
        for first, end, data, offsets in _text.string_slices(batch, "text"):
            dense = features(data, offsets, declared[first:end])[0]
            n, s, ss = n + len(dense), s + dense.sum(0), ss + (dense**2).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(N_DENSE)), pa.array(np.full(N_DENSE, n)), pa.array(s), pa.array(ss)], names=["at", "n", "s", "ss"])


def statistics_scale(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(mean, spread) of the dense statistics over all rows (text, n_chars)."""
    sums = docs.select("text", "n_chars").mapInArrow(_sums, "at long, n long, s double, ss double").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).orderBy("at").toPandas()
    if not len(sums) or not sums["n"][0]:
        return np.zeros(N_DENSE), np.ones(N_DENSE)
    mean = (sums["s"] / sums["n"]).to_numpy()
    return mean, np.sqrt(np.maximum((sums["ss"] / sums["n"]).to_numpy() - mean**2, 0)) + 1e-6


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Machine:
    """A machine from documents (doc_id, text, n_chars) and labels (doc_id, label 0 or 1)."""
    small_batches(docs.sparkSession)
    pairs = labels.where("doc_id is not null and label in (0, 1)").select("doc_id", F.col("label").cast("long").alias("label")).distinct()
    sample = None
    for c in (0, 1):
        own = pairs.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        sample = own if sample is None else sample.union(own)
    given = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text"), F.col("n_chars").cast("double").alias("n_chars"))
    held = given.join(F.broadcast(sample), "doc_id").select("text", "n_chars", "label").mapInArrow(_rows, "label long, dense binary, words binary, share binary").collect()
    machine = Machine()
    y = np.array([r["label"] for r in held], dtype=np.float64)
    if not len(y) or y.min() == y.max():  # one class only: nothing to tell apart
        machine.v[:] = 0
        machine.w0 = 0.0 if not len(y) else 4.0 if y[0] else -4.0
        return machine
    words = [np.frombuffer(r["words"], np.int32) for r in held]
    row = np.repeat(np.arange(len(y)), [len(w) for w in words])
    return machine.fit(np.array([np.frombuffer(r["dense"]) for r in held]), row, np.concatenate(words).astype(np.int64), np.concatenate([np.frombuffer(r["share"], np.float32) for r in held]).astype(np.float64), y, scale=statistics_scale(given))


def _scores(batches, machine):
    m: Machine = machine.value
    for batch in batches:
        declared = np.array(batch.column(2).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.float64)
        z = np.zeros(batch.num_rows)
        for first, end, data, offsets in _text.string_slices(batch, "text"):
            z[first:end] = m.margin(*features(data, offsets, declared[first:end]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["__rest", "__score"])


def score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """`docs` with a column `name`, in place of one that they may have: the chance that the text's label is 1."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    return scored(docs, lambda it: _scores(it, sent), name, text=F.col("text").cast("string"), n_chars=F.col("n_chars").cast("double"))
