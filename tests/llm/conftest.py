"""Fixtures of documents with copies, nulls, ties and awkward texts."""

from __future__ import annotations

import random

import pytest
from brute import prose


@pytest.fixture(scope="session")
def near_copies() -> list[tuple]:
    """Rows (doc_id, text): groups of near copies at and around the threshold, exact copies, short and empty texts."""
    r = random.Random(5)
    rows: list[tuple] = [(900, None), (901, ""), (902, " \n\t "), (903, "one two"), (904, "One  TWO"), (905, "one two three"), (906, "Ünï 漢字 a b c d"), (906, "Ünï 漢字 a b c d"), (None, "one two"), (907, "Ünï 漢字 A b c d")]
    at = 0
    for group in range(12):
        base = prose(r, 60 + 30 * group)
        for copy in range(6):
            text = list(base)
            for _ in range(copy if group % 3 else 0):
                text[r.randrange(len(text))] = "x%d" % r.randrange(10**6)
            rows.append((at, " ".join(text)))
            at += 1
    chain = prose(r, 200)  # each is near the next only: one component
    for k in range(8):
        rows.append((500 + k, " ".join(chain[6 * k : 6 * k + 120])))
    return rows


