"""Best-fit packing of tokenised documents into sequences, with a certified bin count.

Documents become pieces of at most `capacity` tokens (`pieces`): the token ids
of the text and an end token; a longer document is cut so that only its first
piece may be shorter than the capacity. Pieces are dealt to partitions and each
partition is packed by best-fit decreasing. A lower bound by dual feasible
functions certifies its number of bins: where bins and bound agree the
partition is closed; partitions with a gap pool their documents, are dealt
anew and packed again, until next to nothing is gained (`LEAST_GAIN`).

Texts that are null count as empty: one piece that holds only the end token.
Rows with a null doc_id are packed too; repeated rows are packed each.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._store import kept, small_batches

CAPACITY = 1024
END = 2
#: Pieces dealt to a partition, on average.
PARTITION_PIECES = 40_000
#: Rounds go on while one saves a sequence in so many of those it repacks (and one at least).
LEAST_GAIN = 10_000
SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of a byte-level BPE: by `tiktoken` over its ranks, several times as fast as `tokenizers`, which the JSON file is for.

    Where tiktoken gives up (its splitter's stack ends on a run of about a million blanks) the text goes to `tokenizers`.
    """

    def __init__(self, vocabulary: str, pattern: str, file: str):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.lengths = np.zeros(len(ranks) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.lengths[len(ranks)] = len(SPECIAL)
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})
        self.file, self.whole = file, None

    def encode(self, text: str) -> list[int]:
        """The special token's string counts as that token, as `tokenizers` takes it by default."""
        try:
            return self.fast.encode(text, allowed_special={SPECIAL}) if SPECIAL in text else self.fast.encode_ordinary(text)
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # a panic of the native code is not an Exception
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.file)
            return self.whole.encode(text, add_special_tokens=False).ids


def public_vocabulary() -> tuple[str, str, str]:
    """The public 50k byte-level BPE: its ranks, their pre-tokenising pattern, and its file for `tokenizers`."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json")


def _pieces(batches, vocabulary: tuple[str, str, str], capacity: int, end: int):
    enc = Encoder(*vocabulary)
    for batch in batches:
        out: list[tuple] = []
        for row, text in enumerate(batch.column(1)):
            ids = enc.encode(text.as_py() or "")
            ids.append(end)
            n = len(ids)
            flat = np.array(ids, dtype="<u4")
            cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                out.append((row, i, a, b - a, zlib.crc32(flat[a:b])))
        row, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 5
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), *(pa.array(x) for x in (start, length, crc))], names=["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, vocabulary: tuple[str, str, str] | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of documents (doc_id, text).

    `vocabulary` names a byte-level BPE in files that every executor can read: its
    ranks, their pre-tokenising pattern and its `tokenizers` file; by default the public 50k one.
    """
    vocabulary = vocabulary or public_vocabulary()
    small_batches(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(lambda it: _pieces(it, vocabulary, capacity, end), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset, bins): the longest first, each into the fullest bin that it fits."""
    bins, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms, made = 0, 0  # bit r of rooms: some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            room = n + ((fitting & -fitting).bit_length() - 1)
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, at = capacity, made
            made += 1
        bins[i], offset[i] = at, capacity - room
        if room > n:
            by_room[room - n].append(at)
            rooms |= 1 << (room - n)
    return bins, offset, made


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of dual feasible functions applied to the lengths.

    f0 with threshold e: lengths over capacity - e count as whole bins, lengths
    under e as nothing (e up to half the capacity). f1 with k: x -> floor((k+1)x/C)/k
    off the multiples. Each maps every feasible bin to at most one bin's worth.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    total, whole = np.cumsum(count * x), np.cumsum(count)
    best = -(-int(total[-1]) // capacity)
    for e in range(1, capacity // 2 + 1):
        high = whole[-1] - whole[capacity - e]
        middle = total[capacity - e] - total[e - 1]
        best = max(best, int(high) + -(-int(middle) // capacity))
    for k in range(1, 21):
        scaled = (k + 1) * x
        exact = scaled % capacity == 0
        # in units of 1 / (k * capacity): x / capacity where (k+1)x/C is whole, else floor((k+1)x/C) / k
        value = np.where(exact, x * k, scaled // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def _pack(batches, capacity: int):
    """Rows of a task, grouped by `part`, with bin and offset; and the partition's bins and bound."""
    import pyarrow.compute as pc

    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    part = rows.column("part").to_numpy()
    for p in np.unique(part):
        own = rows.filter(pc.equal(rows.column("part"), int(p))).combine_chunks()
        lengths = own.column("length").to_numpy()
        bins, offset, made = best_fit_decreasing(lengths, capacity)
        n = len(lengths)
        extra = [bins, offset, np.full(n, made), np.full(n, lower_bound(lengths, capacity))]
        out = pa.table([*own.columns, *(pa.array(x.astype(np.int64)) for x in extra)], names=[*own.column_names, "bin", "offset", "bins", "bound"])
        yield from out.to_batches(max_chunksize=10_000)


def _dealt(rows: DataFrame, number: int, seed: int) -> DataFrame:
    part = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id(), F.lit(seed)), F.lit(number))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", part.alias("part"))


def packed(rows: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """`pieces` with sequence_id and offset; the pieces of a sequence lie without gaps from offset 0.

    Full pieces are sequences of their own and meet their bound as they are;
    the shorter ones go through the rounds.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, bin long, offset long, bins long, bound long"
    full = rows.where(F.col("length") == capacity)
    left = rows.where(F.col("length") < capacity)
    number = max(1, round(left.count() / partition_pieces))
    closed, best = [], None
    for seed in count():
        # a partition goes whole to one task; several may share one
        now = kept(_dealt(left, number, seed).repartition(number, "part").mapInArrow(lambda it: _pack(it, capacity), schema))
        own = now.groupBy("part").agg(F.max("bins").alias("bins"), F.max("bound").alias("bound"), F.count("*").alias("n"))
        is_open = F.col("bins") > F.col("bound")
        made, rest, parts, n = own.agg(F.sum("bins"), F.sum(F.when(is_open, F.col("bins"))), F.count_if(is_open), F.sum(F.when(is_open, F.col("n")))).first()
        if best is not None and made > best[1] - max(1, best[1] // LEAST_GAIN):
            closed.append(best[0] if made >= best[1] else now)  # dealing anew gained next to nothing
            break
        closed.append(now.where("bins = bound"))
        if not parts:
            break
        left = now.where("bins > bound")
        # half as many partitions, but none over eight times the size
        best, number = (left, rest), max(1, parts // 2, round(n / (8 * partition_pieces)))
    out = full.select("doc_id", "piece", "start", "length", "ids_crc32", (F.monotonically_increasing_id() + (1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for i, df in enumerate(closed):
        number = F.lit(i).cast("long")
        out = out.union(df.select("doc_id", "piece", "start", "length", "ids_crc32", (F.shiftleft(number, 52) + F.shiftleft("part", 28) + F.col("bin")).alias("sequence_id"), "offset"))
    return out


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: tuple[str, str, str] | None = None) -> DataFrame:
    """Pieces of all documents, packed."""
    return packed(kept(pieces(docs, vocabulary, capacity, end)), capacity)
