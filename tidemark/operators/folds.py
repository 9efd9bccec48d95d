"""Folds over ordered rows as streams: rows sorted inside partitions, one state a key, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType, StructField, StructType

#: Keys of a batch are stepped side by side where so many are, on average.
MANY = 12
#: Rows that along() hands to its kernel at once, where a partition has as many.
TOGETHER = 1 << 16


def _values(batch: pa.RecordBatch, columns: list[str]):
    """The rows of some columns as tuples."""
    held = [batch.column(batch.schema.names.index(c)) for c in columns]
    return zip(*(c.to_numpy().tolist() if pa.types.is_integer(c.type) and not c.null_count else c.to_pylist() for c in held))


def fold(df: DataFrame, keys: list[str], order: list[str], inputs: list[str], out: str, kind: DataType, start: Callable, step: Callable) -> DataFrame:
    """df with a column `out`: `step(state, *inputs) -> (state, value)` over each key's rows in order, from `start()`; a struct's value is a tuple of its fields.

    A task holds the state of one key and one batch of rows, however many rows a key has.
    """
    arrow = to_arrow_type(kind)

    def column(values):
        if not isinstance(kind, StructType) or not values:
            return pa.array(values, arrow)
        return pa.StructArray.from_arrays([pa.array(v, field.type) for v, field in zip(zip(*values), arrow)], fields=list(arrow))

    def kernel(batches):
        now, state = None, None
        for batch in batches:
            values = []
            for key, row in zip(_values(batch, keys), _values(batch, inputs)):
                if key != now:
                    now, state = key, start()
                state, value = step(state, *row)
                values.append(value)
            yield pa.RecordBatch.from_arrays([*batch.columns, column(values)], names=[*batch.schema.names, out])

    given = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return given.mapInArrow(kernel, StructType([*df.schema.fields, StructField(out, kind)]))


def reduced(df: DataFrame, keys: list[str], order: list[str], inputs: list[str], out: str, kind: DataType, start: Callable, step: Callable) -> DataFrame:
    """(*keys, out): the state that `step(state, *inputs) -> state` ends with over each key's rows in order, from `start()`."""
    schema = StructType([*(df.schema[c] for c in keys), StructField(out, kind)])
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def kernel(batches):
        now, state, done = None, None, []
        for batch in batches:
            for key, row in zip(_values(batch, keys), _values(batch, inputs)):
                if key != now:
                    if now is not None:
                        done.append((*now, state))
                    now, state = key, start()
                state = step(state, *row)
            if len(done) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*done), kinds)], names=schema.names)
                done = []
        if now is not None:
            done.append((*now, state))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*done), kinds)], names=schema.names)

    given = df.select(*dict.fromkeys([*keys, *order, *inputs])).repartition(*keys).sortWithinPartitions(*keys, *order)
    return given.mapInArrow(kernel, schema)


def averaged(batches: Iterator[pa.RecordBatch], windows: dict[str, int], place: str, size: str) -> Iterator[pa.RecordBatch]:
    """Rows in order with the mean (towards zero) of each column's centred window of odd width in its place; a key's ends are repeated beyond its edges.

    `place` counts a key's rows from 1, `size` is how many it has; a window is no wider than that. What is held of
    earlier batches is as long as a window.
    """
    reach, held, done = max(windows.values()) // 2, None, 0
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        i, n = (held.column(held.schema.names.index(c)).to_numpy().astype(np.int64) for c in (place, size))
        at = np.arange(held.num_rows)
        ready = held.num_rows - int(np.count_nonzero(at + np.minimum(reach, n - i) >= held.num_rows))
        at, i, n = at[done:ready], i[done:ready], n[done:ready]
        given = dict(zip(held.schema.names, held.slice(done, ready - done).columns))
        for c, most in windows.items():
            value = held.column(held.schema.names.index(c)).to_numpy()
            sums = np.concatenate([[0], np.cumsum(value)])
            width = np.where(n >= most, most, np.maximum(1, n - (n % 2 == 0)))
            behind, ahead = np.minimum(width // 2, i - 1), np.minimum(width // 2, n - i)
            total = sums[at + ahead + 1] - sums[at - behind] + (width // 2 - behind) * value[at - behind] + (width // 2 - ahead) * value[at + ahead]
            given[c] = pa.array(np.sign(total) * (np.abs(total) // width))
        yield pa.RecordBatch.from_arrays(list(given.values()), names=list(given))
        kept = max(0, ready - reach)
        held, done = held.slice(kept), ready - kept


def stepped(batches: Iterator[pa.RecordBatch], keys: list[str], inputs: list[str], outs: list[str], begin: Callable, step: Callable) -> Iterator[pa.RecordBatch]:
    """Rows with long columns `outs`: `step(least, most, state, *inputs) -> (state, outs)` over each key's rows, from `begin(*inputs)` of its first.

    Both work on whole numbers and on arrays of them alike: keys that share a batch are stepped side by side, a long one by itself.
    """
    now, state = None, None
    for batch in batches:
        names, count = batch.schema.names, batch.num_rows
        if not count:
            continue
        held = pa.StructArray.from_arrays([batch.column(names.index(k)) for k in keys], keys)
        fresh = np.zeros(count, bool)
        for k in range(len(keys)):
            own = held.field(k)
            same = pc.equal(own[1:], own[:-1])
            fresh[1:] |= ~pc.if_else(pc.is_null(same), pc.and_(pc.is_null(own[1:]), pc.is_null(own[:-1])), same).to_numpy(zero_copy_only=False)
        fresh[0] = held[0].as_py() != now
        starts = np.flatnonzero(fresh | (np.arange(count) == 0))
        lengths = np.diff(np.append(starts, count))
        values = [batch.column(names.index(c)).to_numpy() for c in inputs]
        results = [np.empty(count, np.int64) for _ in outs]
        if count >= MANY * lengths.max():
            rank = np.argsort(-lengths, kind="stable")
            begun, long = starts[rank], lengths[rank]
            states = [np.array(x) for x in begin(*(v[begun] for v in values))]
            if not fresh[0]:
                for x, v in zip(states, state):
                    x[rank == 0] = v
            for t, k in enumerate(np.searchsorted(-long, -np.arange(long[0]))):
                at = begun[:k] + t
                after, out = step(np.minimum, np.maximum, [x[:k] for x in states], *(v[at] for v in values))
                for x, v in zip(states, after):
                    x[:k] = v
                for x, v in zip(results, out):
                    x[at] = v
            state = [int(x[rank == len(starts) - 1][0]) for x in states]
        else:
            rows = []
            for first, *row in zip(fresh.tolist(), *(v.tolist() for v in values)):
                if first:
                    state = begin(*row)
                state, out = step(min, max, state, *row)
                rows.append(out)
            results = [np.array(v, np.int64) for v in zip(*rows)]
        now = held[count - 1].as_py()
        yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, results)], names=[*names, *outs])


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least `rows`, but for the last: the more keys a batch has, the less does a step cost each."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.concat_batches(held)
            held, count = [], 0
    if held:
        yield pa.concat_batches(held)


def along(df: DataFrame, keys: list[str], order: list[str], kept: list[str], outs: list[str], kernel: Callable) -> DataFrame:
    """The columns `kept` of df and long columns `outs`, which `kernel` adds to each partition's batches, in the order of keys and `order`; rows of a key are together."""
    given, together = df.repartition(*keys).sortWithinPartitions(*keys, *order), TOGETHER

    def only(batches):
        for batch in kernel(gathered(batches, together)):
            yield batch.select([*kept, *outs])

    return given.mapInArrow(only, StructType([*(df.schema[c] for c in kept), *(StructField(c, LongType()) for c in outs)]))
