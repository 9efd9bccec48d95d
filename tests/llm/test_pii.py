"""Personal data: the patterns against the plain expressions, the field on held-out sentences, spans over a table."""

from __future__ import annotations

import random
import re
from hashlib import sha256

import numpy as np
import pytest
from compare import TINY

from tidemark.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and by_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((k, *m.span()))
    return out


@pytest.fixture(scope="module")
def field():
    class Rows(list):
        def select(self, *_):
            return self

        collect = list.copy

    return pii.fit(Rows({"text": t, "spans": [{"kind": k, "start": a, "end": z} for k, a, z in found]} for t, found in pii.sentences()))


def test_patterns_equal_the_plain_expressions():
    r = random.Random(2)
    parts = ["@", ".", "-", " ", "+", "(", ")", "a", "Z", "é", "1", "25", "255", "4111111111111111", "a@b.c", "1.2.3.4", "+12 (345) 678-90", "\n", "_", "%"]
    for _ in range(6000):
        text = "".join(r.choices(parts, k=r.randrange(1, 14)))
        assert pii.base_spans(text) == plain(text), text
    for text in ("a@b@c.d@e.f", "x" * 50 + "@y.z.", "1.2.3.4.5.6.7.8.9", "001.2.03.255", "256.1.1.1", "4111 1111-1111 1111", "+123456789", "++1 23 45 67 89", "0" * 30 + ".1.1.1", ""):
        assert pii.base_spans(text) == plain(text), text


def test_patterns_take_linear_time():
    n = 300_000
    for text in ("1" * n, "a" * n + "@", "a@" * n, "+1" + " " * n, "1." * n, "1 " * n, "@" * n, "+" * n, "x@" + "a" * n, "(at)" * (n // 20)):
        pii.base_spans(text)
        assert all(0 <= a <= z <= len(text) for a, z in pii.stretches(text))


def test_stretches_hold_every_sign_once():
    r = random.Random(5)
    for _ in range(800):
        text = "".join(r.choices(["word ", "12", "@", "(at)", "\n", "  ", "long" * 30, "a at b dot c ", "é"], k=r.randrange(1, 40)))
        cut = pii.stretches(text)
        assert all(a[1] <= b[0] for a, b in zip(cut, cut[1:]))
        assert all(any(a <= m.start() and m.end() <= z for a, z in cut) for m in re.finditer(r"[0-9@]", text))
        assert not any("\n" in text[a:z].strip("\n") for a, z in cut)


def tagged(field, text):
    sequences = pii.Sequences(field.lexicon)
    sequences.add(text, 0, len(text))
    labels = field.decode(sequences)
    return {(pii.KINDS[k], s, e) for k, s, e in pii._added(text, sequences, labels, 0, len(labels), [])}


def test_field_on_held_out_sentences(field):
    both = found = wanted = 0
    for text, spans in pii.sentences(400, seed=99):
        got, want = tagged(field, text), set(spans)
        both, found, wanted = both + len(got & want), found + len(got), wanted + len(want)
    assert both / found > 0.9 and both / wanted > 0.85


def test_field_is_the_best_path(field):
    """Viterbi over padded batches equals the best of all paths of short sequences."""
    sequences = pii.Sequences(field.lexicon)
    texts = ["call 555-1234", "a (at) b.de", "12", "Karte 4111"]
    for t in texts:
        sequences.add(t, 0, len(t))
    labels, at = field.decode(sequences), 0
    scores = field.weights[sequences.features()].sum(axis=1)
    for n in sequences.lengths:
        best = {(): (0.0, None)}
        for k in range(at, at + n):
            after = {}
            for path, (score, last) in best.items():
                for label in range(pii.LABELS):
                    s = score + scores[k, label] + (field.first[label] if last is None else field.moves[last, label])
                    if (label,) not in after or s > after[label,][0]:
                        after[label,] = (s, label, path)
            best = {key: (s, label) for key, (s, label, _) in after.items()}
            trail = [after] if k == at else [*trail, after]
        key, path = max(best, key=lambda p: best[p][0]), []
        for step in reversed(trail):
            path.append(key[0])
            key = step[key][2]
        assert list(labels[at : at + n]) == path[::-1]
        at += n


def test_likelihood_gradient():
    """The analytic gradient of moves equals differences of the likelihood."""
    r = np.random.default_rng(1)
    field = pii.Field({})
    field.moves += np.where(pii._allowed(), r.normal(size=field.moves.shape), 0)
    scores, there = r.normal(size=(2, 5, pii.LABELS)), np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0]], bool)
    labels = np.array([[0, 1, 2, 0, 3], [1, 2, 0, 0, 0]])

    def loss():
        total = 0.0
        for s, on, own in zip(scores, there, labels):
            n = int(on.sum())
            sums, truth = s[0] + field.first, s[0, own[0]] + field.first[own[0]]
            for k in range(1, n):
                sums = np.logaddexp.reduce(sums[:, None] + field.moves, axis=0) + s[k]
                truth += field.moves[own[k - 1], own[k]] + s[k, own[k]]
            total += np.logaddexp.reduce(sums) - truth
        return total

    gap, moved = field._gradient(scores, there, labels)
    for a, b in ((0, 0), (1, 2), (2, 0), (0, 3)):
        field.moves[a, b] += 1e-5
        up = loss()
        field.moves[a, b] -= 2e-5
        assert abs((up - loss()) / 2e-5 - moved[a, b]) < 1e-4
        field.moves[a, b] += 1e-5
    scores[0, 1, 1] += 1e-5
    up = loss()
    scores[0, 1, 1] -= 2e-5
    assert abs((up - loss()) / 2e-5 - gap[0, 1, 1]) < 1e-4


def test_spans_over_a_table(spark, field):
    phone = "please call (487) 555-7209 today"
    rows = [(1, "to ann@mail.com, 10.0.0.1", "k"), (1, "to ann@mail.com, 10.0.0.1", "k"), (2, None, None), (3, "", ""), (None, phone, ""), (4, "plain words only", ""), (5, ("é " * 4000 + "4111 1111 1111 1111 ") * 2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __spans string").withColumnRenamed("__spans", "kind")
    out = pii.digest_of(pii.private_spans(docs, field)).collect()
    assert len(out) == len(rows) and len(out[0].asDict()) == 8
    by = {(r["doc_id"], r["spans"]): r for r in out}
    assert by[1, "email:3:15,ip:17:25"]["n_email"] == 1 and by[1, "email:3:15,ip:17:25"]["n_added"] == 0
    assert by[None, "phone:12:26"]["n_phone"] == 0 and by[None, "phone:12:26"]["n_added"] == 1
    assert {by[d, ""]["base_sha256"] for d in (2, 3, 4)} == {sha256(b"").hexdigest()}
    assert [r["n_card"] for r in out if r["doc_id"] == 5] == [2]
    for r in out:
        text = next(t for d, t, _ in rows if d == r["doc_id"]) or ""
        assert r["base_sha256"] == pii.text_hash(text)
    clean = {r["doc_id"]: r["text"] for r in pii.redacted(docs, field).collect()}
    assert clean[1] == "to [EMAIL], [IP]" and clean[None] == "please call [PHONE] today" and clean[2] is None and clean[4] == "plain words only"
    assert pii.private_spans(docs.limit(0), field).columns == ["doc_id", "text", "kind", "__spans"] and pii.private_spans(docs.limit(0), field).count() == 0


def test_query_against_brute_force(spark):
    out = queries.QUERIES["op11_pii"](spark, TINY)
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    got = {r["doc_id"]: r for r in out.collect()}
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    assert set(got) == set(docs)
    for d, text in docs.items():
        base = plain(text)
        listed = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert got[d]["base_sha256"] == sha256(",".join(listed).encode()).hexdigest()
        assert [got[d][f"n_{k}"] for k in pii.KINDS] == [sum(x.startswith(k + ":") for x in listed) for k in pii.KINDS]
        spans = got[d]["spans"].split(",") if got[d]["spans"] else []
        assert set(listed) <= set(spans) and len(spans) == len(listed) + got[d]["n_added"]
        assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x.split(":")[0]), int(x.split(":")[1])))


def test_a_table_without_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    field = pii.fit(pii.labelled_texts(spark, 40), pii.ordinary_texts(none))
    assert pii.digest_of(pii.private_spans(none, field)).collect() == []
