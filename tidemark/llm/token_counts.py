"""Token counts by section: each document is encoded once and its tokens are attributed by their offsets.

A record's fields are laid end to end with a separator and encoded as one
text; fields, or the sections given inside them, are half-open character ranges
that tile it. Each token's character span comes from the byte lengths of the
tokens before it; a sorted interval join matches tokens with sections. A token
that crosses a boundary belongs to the section that holds its first character
(`rule="first"`), or to the one that holds most of its characters, the earlier
on ties (`rule="most"`). A token that lies inside one character counts as
that character.

A null field is an empty section with no token. Rows with a null id are counted
too; repeated rows are counted each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._store import small_batches
from tidemark.llm.packing import Encoder, public_vocabulary


def spans(enc: Encoder, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) in characters of each token of a text."""
    ids = np.array(enc.encode(text), np.int64)
    raw = np.frombuffer(text.encode(), np.uint8)
    stop = np.cumsum(enc.lengths[ids])
    start = stop - enc.lengths[ids]
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters that begin before a byte
    inside = np.append((raw & 0xC0) == 0x80, False)
    return lead[start] - inside[start], lead[stop]


def attribute(start: np.ndarray, end: np.ndarray, edges: np.ndarray, rule: str = "first") -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a boundary); section i is edges[i] to edges[i + 1]."""
    first = np.searchsorted(edges, start, side="right") - 1
    last = np.searchsorted(edges, np.maximum(end - 1, start), side="right") - 1
    crosses = last > first
    if rule == "most" and crosses.any():
        for t in np.flatnonzero(crosses):
            own = np.arange(first[t], last[t] + 1)
            held = np.minimum(edges[own + 1], end[t]) - np.maximum(edges[own], start[t])
            first[t] = own[int(np.argmax(held))]
    return first, crosses


def _counts(batches, fields: list[str], separator: str, by_line: bool, rule: str, vocabulary: tuple[str, str, str]):
    enc = Encoder(*vocabulary)
    for batch in batches:
        columns = [batch.column(i + 1).to_pylist() for i in range(len(fields))]
        out: list[tuple[np.ndarray, ...]] = []
        names: list[np.ndarray] = []
        for row, values in enumerate(zip(*columns)):
            edges, field, number, at = [0], [], [], 0
            for i, value in enumerate(values):
                parts = (value or "").split("\n") if by_line else [value or ""]
                for k, part in enumerate(parts):
                    at += len(part) + (len(separator) if k == len(parts) - 1 and i < len(fields) - 1 else k < len(parts) - 1)
                    edges.append(at)
                    field.append(i)
                    number.append(k)
            edges = np.array(edges, np.int64)
            start, end = spans(enc, separator.join(v or "" for v in values))
            # an empty section shares its start with the next one: side="right" gives tokens to the last of them
            section, crosses = attribute(start, end, edges, rule)
            n = len(field)
            section = np.minimum(section, n - 1)
            out.append((np.full(n, row), np.array(number), edges[:-1], edges[1:], np.bincount(section, minlength=n), np.bincount(section[crosses], minlength=n)))
            names.append(np.array(field))
        cols = [np.concatenate(c).astype(np.int64) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 6
        field = np.concatenate(names) if names else np.zeros(0, np.int64)
        for i in range(0, len(field), 50_000):
            cut = slice(i, i + 50_000)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0][cut])), pa.array(np.array(fields, dtype=object)[field[cut]], pa.string()), *(pa.array(c[cut]) for c in cols[1:])], names=["id", "field", "section", "start", "end", "n_tokens", "n_crossing"])


def section_tokens(df: DataFrame, id: str, fields: list[str], by_line: bool = False, separator: str = "\n", rule: str = "first", vocabulary: tuple[str, str, str] | None = None) -> DataFrame:
    """(id, field, section, start, end, n_tokens, n_crossing), one row per section of each row of df.

    Without `by_line` a field is one section; with it each of its lines is, and
    the newline belongs to the line that it ends.
    """
    if rule not in ("first", "most"):
        raise ValueError("rule is first or most")
    vocabulary = vocabulary or public_vocabulary()
    small_batches(df.sparkSession)
    given = df.select(F.col(id).cast("long").alias("id"), *(F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)))
    return given.mapInArrow(lambda it: _counts(it, fields, separator, by_line, rule, vocabulary), "id long, field string, section long, start long, end long, n_tokens long, n_crossing long")
