"""Plain Python versions of the corpus operators, for small fixtures."""

from __future__ import annotations

import random
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[i] = j
        return i != j


def prose(r: random.Random, n: int, names: int = 400) -> list[str]:
    return ["w%d" % r.randrange(names) for _ in range(n)]


def low(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(low(text or ""))


def shingles(text: str | None, size: int = 5) -> set[tuple]:
    w = words(text)
    if not w:
        return set()
    return {tuple(w)} if len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def jaccard(docs: list[tuple], percent: int = 80) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of rows (doc_id, text)."""
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and docs[i][0] is not None and docs[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), None if d is None else least[root(i)]) for i, (d, _) in enumerate(docs)]


def contained(docs: list[tuple], items: list[tuple], percent: int = 80) -> set[tuple]:
    """(doc_id, item_id, n_shingles, n_found)."""
    out = set()
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            if d is None or i is None or not v:
                continue
            size = min(5, len(v))
            own = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
            wanted = {tuple(v[k : k + size]) for k in range(len(v) - size + 1)}
            n = len(own & wanted)
            if 100 * n >= percent * len(wanted):
                out.add((d, i, len(wanted), n))
    return out


def without_runs(docs: list[tuple], least: int = 2) -> dict:
    """Texts after line dedup, by (doc_id, text); later copies of runs of `least` lines go with the blank lines inside."""
    kept = {}
    seen: dict[tuple, tuple] = {}
    places = defaultdict(list)
    # the order of rows of one doc_id is by a hash; fixtures have one text a doc_id where it matters
    for d, text in sorted({(d, t) for d, t in docs if d is not None and t is not None}):
        raw = text.split("\n")
        bare = [(i, x.strip("\t\x0b\x0c\r ")) for i, x in enumerate(raw) if x.strip("\t\x0b\x0c\r ")]
        for k in range(len(bare) - least + 1):
            run = tuple(x for _, x in bare[k : k + least])
            if run in seen:
                places[d, text].append((bare[k][0], bare[k + least - 1][0]))
            else:
                seen[run] = (d, k)
    for d, text in docs:
        gone = {i for a, b in places.get((d, text), []) for i in range(a, b + 1)}
        kept[d, text] = text if not gone else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return kept


def sentences(text: str) -> list[tuple[int, int, tuple]]:
    """(start, end, words) of sentences in characters; none may be long enough to be divided."""
    found = list(WORD.finditer(text))
    out, own = [], []
    for k, m in enumerate(found):
        own.append(m)
        following = found[k + 1].start() if k + 1 < len(found) else len(text)
        inner = m[0][-2] if len(m[0]) > 1 and m[0][-1] in "\"')]}" else m[0][-1]
        if inner in ".!?" or "\n" in text[m.end() : following] or k + 1 == len(found):
            out.append((own[0].start(), following, tuple(low(x[0]) for x in own)))
            own = []
    return out


def without_spans(docs: list[tuple], span: int = 3, least: int = 12) -> dict:
    """Texts without sentences that a later copy of a run covers, by doc_id (one text each)."""
    seen, out = set(), {}
    for d, text in sorted((d, t) for d, t in docs if d is not None and t is not None):
        s = sentences(text)
        gone = set()
        for i in range(len(s)):
            j = i + span
            while j <= len(s) and sum(len(x[2]) for x in s[i:j]) < least:
                j += 1
            if j > len(s):
                continue
            run = tuple(w for x in s[i:j] for w in x[2])
            if run in seen:
                gone |= set(range(i, j))
            seen.add(run)
        cut = sorted(gone)
        kept, at = [], 0
        for i in cut:
            kept.append(text[at : s[i][0]])
            at = s[i][1]
        out[d] = "".join([*kept, text[at:]])
    return out
