"""Substring dedup over sliding runs of sentences.

A sentence ends at a word that closes with . ! or ? (quotes and brackets may
follow), at a newline, or with the text; one of more than `LONG` words is divided further. From every sentence
the shortest run of at least `span` consecutive sentences and `min_words` words is
hashed over its words, so case of A-Z and white space don't count. Runs are joined globally; the first by
(doc_id, place) stays, and every sentence that a later one covers is removed
with the white space behind it. The rest of the text stays as it is.

A passage that begins and ends inside sentences may hold too few whole ones. So
sentences are also cut into pieces where their own words say: of every `WINDOW`
consecutive words without a sentence's end the word of least hash ends a piece.
Runs of `span` pieces and `PIECE_WORDS` words are joined likewise, apart from those of
sentences. Any passage of 50 words holds one that lies alike in all its copies.

Null texts stay null and have no sentences. Rows with a null doc_id stay as they
are. Rows of equal doc_id and text count as one; each gets the same result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm import _text
from tidemark.llm._store import hot_join, kept, small_batches, small_lists, wrapped

SPAN = 3
MIN_WORDS = 12
#: A sentence of more words (tables, lists, text without stops) is divided behind about every eighth word, chosen by its hash.
LONG = 24
WINDOW = 8
PIECE_WORDS = 20
#: Passages of so many words always hold a run. Runs of pieces are made only where that many words may hold none of whole sentences.
PASSAGE = 50
#: Documents and places up to this number are broadcast (about 8 MB); beyond it Spark joins by shuffle.
SMALL_VALUES = 1_000_000

_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True
_CLOSER = np.zeros(256, dtype=bool)
_CLOSER[list(b"\"')]}")] = True


def _least(hashes: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A flag for each word that is the least (the last of equals) of WINDOW words none of which ends a sentence."""
    out = np.zeros(len(hashes), bool)
    m = len(hashes) - WINDOW + 1
    if m < 1:
        return out
    least, at = hashes[:m].copy(), np.zeros(m, np.int64)
    for k in range(1, WINDOW):
        other = hashes[k : m + k]
        lower = other <= least
        least[lower], at[lower] = other[lower], k
    stops = np.concatenate([[0], np.cumsum(stop)])
    free = np.flatnonzero(stops[WINDOW:] == stops[:m])
    out[free + at[free]] = True
    return out


def sentences(data: np.ndarray, offsets: np.ndarray):
    """(first word, end word, bounds by row, word table, pieces) of the sentences of all rows; pieces are (first word, end word, bounds by row, whether cut inside a sentence)."""
    starts, ends, hashes, bounds = _text.words(data, offsets)
    n = len(starts)
    if not n:
        empty, at = np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        return empty, empty, at, (starts, ends, hashes, bounds), (empty, empty, at, np.zeros(0, bool))
    last = data[ends - 1]
    inner = np.where((ends - starts > 1) & _CLOSER[last], data[np.maximum(ends - 2, 0)], last)
    breaks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=breaks[1:])
    following = np.append(starts[1:], len(data))
    stop = _STOP[inner] | (breaks[following] > breaks[ends])
    stop[bounds[1:][np.diff(bounds) > 0] - 1] = True
    inside = _least(hashes, stop)
    piece_end = np.flatnonzero(stop | inside) + 1
    piece = np.concatenate([[0], piece_end[:-1]])
    pieces = (piece, piece_end, np.searchsorted(piece, bounds), inside[piece_end - 1])
    end = np.flatnonzero(stop) + 1
    size = np.diff(end, prepend=0)
    if (size > LONG).any():  # divided where its own words say, so that equal passages are divided alike
        stop |= np.repeat(size > LONG, size) & (hashes >> np.uint64(61) == 0)
        end = np.flatnonzero(stop) + 1
    first = np.concatenate([[0], end[:-1]])
    return first, end, np.searchsorted(first, bounds), (starts, ends, hashes, bounds), pieces


def run_ends(first: np.ndarray, end: np.ndarray, span: int, min_words: int) -> np.ndarray:
    """For each sentence the end (a sentence number) of the shortest run from it with `span` sentences and `min_words` words."""
    return np.maximum(np.arange(len(first)) + span, np.searchsorted(end, first + min_words) + 1)


def word_runs(first: np.ndarray, end: np.ndarray, at: np.ndarray, pieces: tuple, span: int, min_words: int):
    """(row, first word, end word, kind) of all runs: kind 0 of sentences, kind 1 of pieces of which one is cut inside a sentence."""
    out = []
    piece, piece_end, piece_at, inside = pieces
    # lacking: how many of the first x words begin PASSAGE words of one row without a run of whole sentences
    natural = piece_end[~inside]
    begin = np.concatenate([[0], natural[:-1]]) if len(natural) else natural
    bounds = np.append(piece, piece_end[-1:])[piece_at] if len(piece) else piece_at
    to = run_ends(begin, natural, span, min_words)
    far = np.iinfo(np.int64).max
    until = np.append(np.where(to <= len(natural), natural[np.minimum(to, len(natural)) - 1] if len(natural) else 0, far), far)
    x = np.arange(int(bounds[-1]))
    last = x + PASSAGE
    lacking = np.concatenate([[0], np.cumsum((until[np.searchsorted(begin, x)] > last) & (last <= np.repeat(bounds[1:], np.diff(bounds))))])
    for kind, (a, b, of, least) in enumerate([(first, end, at, min_words), (piece, piece_end, piece_at, max(min_words, PIECE_WORDS))]):
        to = run_ends(a, b, span, least)
        row = np.repeat(np.arange(len(of) - 1), np.diff(of))
        good = to <= np.repeat(of[1:], np.diff(of))
        if kind:
            cuts = np.concatenate([[0], np.cumsum(inside)])
            good &= (cuts[np.minimum(to, len(a))] > cuts[:-1]) | np.concatenate([[False], inside[:-1]])[: len(a)]
            run_end = b[np.minimum(to, len(b)) - 1] if len(b) else b
            good &= lacking[a + 1] > lacking[np.minimum(np.maximum(run_end - PASSAGE, bounds[row]), a)]
        good = np.flatnonzero(good)
        out.append((row[good], a[good], b[to[good] - 1], np.full(len(good), kind)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _runs(batches, span: int, min_words: int):
    for batch in batches:
        for row, _, data, offsets in _text.string_slices(batch, "text"):
            first, end, at, (_, _, hashes, bounds), pieces = sentences(data, offsets)
            doc, a, b, kind = word_runs(first, end, at, pieces, span, min_words)
            place = 2 * (a - bounds[doc]) + kind  # in the order of the text
            h1 = _text.range_hash(hashes, a, b) ^ np.where(kind == 1, np.uint64(0x9E3779B97F4A7C15), np.uint64(0))
            h2 = (_text.range_hash(_text.mix(hashes), a, b) >> np.uint64(33)).astype(np.int32)
            for i in range(0, len(a), 50_000):
                part = slice(i, i + 50_000)
                rows = pa.array(doc[part] + row)
                yield pa.RecordBatch.from_arrays([pa.array(h1[part].view(np.int64)), pa.array(h2[part]), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(place[part].astype(np.int32))], names=["h1", "h2", "doc_id", "version", "place"])


def _remove(batches, span: int, min_words: int, keep: list[str]):
    for batch in batches:
        index = {n: i for i, n in enumerate(batch.schema.names)}
        texts, spans = batch.column(index["text"]).to_pylist(), batch.column(index["__places"]).to_pylist()
        total, gone, out = [0] * len(texts), [0] * len(texts), list(texts)
        for row, end_row, data, offsets in _text.string_slices(batch, "text"):
            first, end, at, (starts, _, _, bounds), pieces = sentences(data, offsets)
            doc, run, run_end, kind = word_runs(first, end, at, pieces, span, min_words)
            of = np.searchsorted(doc[kind == 0], np.arange(end_row - row + 1)), np.searchsorted(doc[kind == 1], np.arange(end_row - row + 1))
            sides = [(run[kind == x], run_end[kind == x]) for x in (0, 1)]
            for i in range(row, end_row):
                k = i - row
                total[i] = int(at[k + 1] - at[k])
                if not spans[i] or texts[i] is None:
                    continue
                n = int(bounds[k + 1] - bounds[k])
                cover = np.zeros(n + 1, np.int64)
                places = np.array(spans[i])
                for x, (a, b) in enumerate(sides):
                    a, b = a[of[x][k] : of[x][k + 1]] - bounds[k], b[of[x][k] : of[x][k + 1]] - bounds[k]
                    own = places[places % 2 == x] // 2
                    np.add.at(cover, own, 1)
                    np.add.at(cover, b[np.searchsorted(a, own)], -1)
                drop = np.cumsum(cover)[:n] > 0
                gone[i] = int(np.logical_or.reduceat(drop, first[at[k] : at[k + 1]] - bounds[k]).sum())
                own = data[offsets[k] : offsets[k + 1]]
                begin = np.append(starts[bounds[k] : bounds[k + 1]] - offsets[k], len(own))
                step = np.zeros(len(own) + 1, np.int8)
                edge = np.flatnonzero(np.diff(np.concatenate([[False], drop, [False]])))
                step[begin[edge[0::2]]] += 1
                step[begin[edge[1::2]]] -= 1
                out[i] = own[np.cumsum(step[:-1]) == 0].tobytes().decode("utf-8")
        columns = [pa.array(out, pa.string()) if n == "text" else batch.column(index[n]) for n in keep]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=[*keep, "__sentences", "__removed"])


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with `__version`, which tells apart rows of one doc_id by their text; 0 where every doc_id is single."""
    again = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    return docs.withColumn("__version", F.lit(0).cast("long") if again.isEmpty() else F.coalesce(F.xxhash64(F.col("text").cast("string")), F.lit(0)).cast("long"))


def repeated_spans(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, version, place): every run that repeats an earlier one; place is twice the number of its first word, and 1 more for a run of pieces."""
    return _repeated(_keyed(docs.select("doc_id", "text")), span, min_words)


def _repeated(keyed: DataFrame, span: int, min_words: int) -> DataFrame:
    """repeated_spans() of rows that have their __version."""
    given = keyed.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("__version").alias("version"), F.col("text").cast("string").alias("text"))
    runs = given.mapInArrow(lambda it: _runs(it, span, min_words), "h1 long, h2 int, doc_id long, version long, place int")
    at = F.struct("doc_id", "version", "place")
    repeated = kept(runs.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first", "n"))
    return hot_join(runs, repeated, ["h1", "h2"]).where(at != F.col("first")).select("doc_id", "version", "place").distinct()


def without_repeated_spans(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs`, all columns kept, with repeated spans removed from `text`, and __sentences and __removed counted (columns of these names give way)."""
    small_batches(docs.sparkSession)
    keyed = _keyed(wrapped(docs, "doc_id", "text"))
    places = kept(_repeated(keyed, span, min_words).groupBy("doc_id", "version").agg(F.collect_list("place").alias("__places")).select(F.col("doc_id").alias("__doc"), F.col("version").alias("__of"), "__places"))
    both = keyed.join(small_lists(places, "__places", SMALL_VALUES), (F.col("doc_id").cast("long") == F.col("__doc")) & (F.col("__version") == F.col("__of")), "left")
    both = both.select("doc_id", F.col("text").cast("string").alias("text"), "__rest", "__places")
    counted = [StructField("__sentences", LongType()), StructField("__removed", LongType())]
    out = both.mapInArrow(lambda it: _remove(it, span, min_words, ["doc_id", "text", "__rest"]), StructType([*both.schema.fields[:3], *counted]))
    own = [F.col(c) if c in ("doc_id", "text") else F.col("__rest").getField(c).alias(c) for c in docs.columns if c not in ("__sentences", "__removed")]
    return out.select(*own, "__sentences", "__removed")
