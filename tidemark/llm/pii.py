"""Personal data in texts: exact patterns, and what a linear-chain conditional random field adds to them.

The patterns (e-mail addresses, IP addresses, card numbers, telephone numbers) are matched leftmost and without overlap,
each kind by itself; matches that fail their check (parts up to 255, the Luhn sum, the number of digits) go. Their spans
always stay. The field then tags pieces of text (runs of letters, runs of digits, single other characters) as beginning
or going on with one of the kinds, from features of shape: a piece's and its neighbours' shapes, the lay-out of the
number that it is part of, and words that the labelled table knows. So it finds what the patterns miss: numbers without
a plus, addresses with `(at)`, cards that are mistyped behind a word for them. Spans that meet one of the patterns' or
are of an impossible length go.

The field learns by gradient steps on the likelihood of a small labelled table (texts and their spans): sentences of
`labelled_texts`, and stretches of at most FIT_DOCS documents, labelled by the patterns, that show the corpus's ordinary
numbers. It is decoded by Viterbi, many sequences at a time in numpy. Its sequences are the stretches of a line around
each piece that may be personal data (digits, @, a bracketed or spelled-out at), MARGIN characters to either side;
elsewhere nothing is added. Sequences of over LONGEST pieces are cut there.

Null and empty texts have no spans. Positions are code points, ends exclusive. Rows with a null or repeated doc_id are
kept as they are. An empty table gives no rows, and a field that has learned from the labelled sentences only.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import _text
from tidemark.llm._store import small_batches

KINDS = ("email", "ip", "card", "phone")
#: Documents that show a corpus's ordinary numbers, stretches taken of them, labelled sentences made.
FIT_DOCS, FIT_STRETCHES, FIT_SENTENCES = 1500, 1500, 900
MARGIN, LONGEST = 48, 4096
#: Weights of hashed features; passes over the labelled table.
TABLE, PASSES = 1 << 15, 12
_SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"

#: The patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    """Each @ with what stands before it, back to the last match, and a domain behind it. As the local part has no @, a failing @ leaves all before it free."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield 0, start, domain.end()
            floor = domain.end()
        else:
            floor = at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all matches of the patterns that hold their check, by kind, then start. Linear in the text."""
    out = list(_emails(text))
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    out += [(2, *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() <= 37 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


# --- sequences of pieces and their features

_PIECE = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
_SIGN = re.compile(r"[0-9]+|@|[(\[{]at[)\]}]| at \S{1,60} dot ")
_PLAIN_SIGN = re.compile(r"[0-9]+|@")
_NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[ .()/:-]{0,2}[0-9]){0,63}+")


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text that may hold personal data, on one line each, without overlap."""
    out: list[list[int]] = []
    spelled = "at)" in text or "at]" in text or "at}" in text or " dot " in text
    for m in (_SIGN if spelled else _PLAIN_SIGN).finditer(text):
        a, z = m.span()
        if out and a <= out[-1][1] and text.find("\n", out[-1][2], a) < 0:
            out[-1][1], out[-1][2] = max(out[-1][1], z + MARGIN), z
        else:
            out.append([a - MARGIN, z + MARGIN, z, a])
    cut, before = [], 0
    for a, z, last, first in out:
        a = max(a, before, text.rfind("\n", max(a, 0), first) + 1)
        line = text.find("\n", last, min(z, len(text)))
        z = min(line if line >= 0 else z, len(text))
        if a and a > before and not text[a - 1].isspace():  # not in the middle of a word, unless it has no end here
            a = next((i + 1 for i in range(a, first) if text[i].isspace()), a)
        if z < len(text) and not text[z].isspace():
            z = next((i for i in range(z, last, -1) if text[i - 1].isspace()), z)
        cut.append((a, z))
        before = z
    return cut


_SHAPES: dict[str, int] = {}


def _shape(piece: str) -> int:
    """A number for a piece's looks: case and length of letters, length of digits, or the character itself."""
    code = _SHAPES.get(piece)
    if code is None:
        if piece[0].isdigit():
            looks = f"d{min(len(piece), 20)}"
        elif piece[0].isalpha():
            looks = ("U" if piece.isupper() else "T" if piece[0].isupper() else "l") + str(min(len(piece), 4))
        else:
            looks = piece
        code = crc32(looks.encode())
        if len(_SHAPES) < 200_000:
            _SHAPES[piece] = code
    return code


def _layout(number: str) -> tuple[int, int]:
    """Numbers for the lay-out of a number: lengths of its groups and what divides them; its digits, and whether they hold the Luhn sum."""
    digits = _digits(number)
    groups = re.sub(r"[0-9]+", lambda m: str(min(len(m.group()), 20)), number)[:40]
    return crc32(groups.encode()) + 1, 2 * min(len(digits), 24) + (13 <= len(digits) <= 19 and luhn(digits)) + 1


class Sequences:
    """Pieces of many stretches, one after the other, with their features."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon = lexicon
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.codes: list[tuple[int, int, int, int, int, int]] = []
        self.lengths: list[int] = []

    def add(self, text: str, a: int, z: int) -> int:
        """Adds the pieces of text[a:z]; how many sequences they make."""
        numbers = [(m.start(), m.end(), *_layout(m.group())) for m in _NUMBER.finditer(text, a, z)]
        k, n, place, last = 0, 0, 0, a
        for m in _PIECE.finditer(text, a, z):
            piece, (s, e) = m.group(), m.span()
            while k < len(numbers) and numbers[k][1] <= s:
                k, place = k + 1, 0
            layout = digits = at = 0
            if k < len(numbers) and numbers[k][0] <= s:
                place += 1
                layout, digits, at = numbers[k][2], numbers[k][3], min(place, 12)
            self.starts.append(s)
            self.ends.append(e)
            self.codes.append((_shape(piece), self.lexicon.get(piece.lower(), 0) if piece[0].isalpha() else 0, layout, digits, at, s > last or s == a))
            last = e
            n += 1
        self.lengths += [LONGEST] * (n // LONGEST) + [n % LONGEST] * (n % LONGEST > 0)
        return -(-n // LONGEST)

    def features(self) -> np.ndarray:
        """Indices into the table of weights, a row a piece."""
        n = len(self.codes)
        shape, word, layout, digits, place, space = np.array(self.codes, dtype=np.int64).reshape(n, 6).astype(np.uint64).T
        row = np.repeat(np.arange(len(self.lengths)), self.lengths)

        def by(values: np.ndarray, step: int) -> np.ndarray:
            """The values of the pieces `step` away, 0 beyond a sequence."""
            out = np.zeros(n, np.uint64)
            if step > 0 and step < n:
                out[:-step] = np.where(row[step:] == row[:-step], values[step:], 0)
            elif step < 0 and -step < n:
                out[-step:] = np.where(row[:step] == row[-step:], values[:step], 0)
            return out

        spaced = shape * np.uint64(2) + space
        near = {k: spaced if not k else by(spaced, k) for k in range(-3, 4)}
        words = {k: word if not k else by(word, k) for k in range(-4, 4)}
        cue_before = words[-1] | words[-2] | words[-3] | words[-4]
        own = [np.zeros(n, np.uint64), layout, layout * np.uint64(16) + place, digits, digits * np.uint64(16) + place, cue_before, cue_before * np.uint64(64) + digits]
        own += [near[k] for k in near] + [words[k] for k in words]
        own += [near[a] * np.uint64(0x9E3779B1) + near[a + 1] for a in range(-3, 3)]
        own += [(near[a] * np.uint64(0x9E3779B1) + near[a + 1]) * np.uint64(0x85EBCA77) + near[a + 2] for a in range(-2, 1)]
        with np.errstate(over="ignore"):
            return np.stack([(_text.mix(v * np.uint64(64) + np.uint64(slot)) % np.uint64(TABLE)).astype(np.int32) for slot, v in enumerate(own)], axis=1)


# --- the field

LABELS = 1 + 2 * len(KINDS)  # 0: none; 1 + 2k: a span of kind k begins; 2 + 2k: it goes on


def _allowed() -> np.ndarray:
    """Which label may follow which: a span goes on only behind its own kind."""
    out = np.ones((LABELS, LABELS), bool)
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = False
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return out


_NEVER = -1e6


class Field:
    """Weights of a linear-chain conditional random field."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon = lexicon
        self.weights = np.zeros((TABLE, LABELS))
        self.moves = np.where(_allowed(), 0.0, _NEVER)
        self.first = np.where(np.arange(LABELS) % 2 == 1, 0.0, _NEVER)
        self.first[0] = 0.0

    def _padded(self, lengths: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, there) of sequences, a row each, padded to the longest."""
        step = np.arange(lengths.max())
        there = step[None, :] < lengths[:, None]
        return np.where(there, starts[:, None] + step[None, :], 0), there

    def _gradient(self, scores: np.ndarray, there: np.ndarray, labels: np.ndarray):
        """Chances less truth of labels, and of moves, by forward and backward sums."""
        b, t, _ = scores.shape
        moves = np.exp(np.maximum(self.moves, -700))
        top = scores.max(axis=2, keepdims=True)
        local = np.exp(scores - top)
        local[:, 0] *= np.exp(np.maximum(self.first, -700))
        forward, back = np.empty_like(local), np.ones_like(local)
        forward[:, 0] = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
        for k in range(1, t):
            now = (forward[:, k - 1] @ moves) * local[:, k]
            forward[:, k] = np.where(there[:, k, None], now / now.sum(axis=1, keepdims=True), forward[:, k - 1])
        for k in range(t - 2, -1, -1):
            now = (back[:, k + 1] * local[:, k + 1]) @ moves.T
            back[:, k] = np.where(there[:, k + 1, None], now / now.sum(axis=1, keepdims=True), 1.0)
        chance = forward * back
        chance /= chance.sum(axis=2, keepdims=True)
        truth = np.eye(LABELS)[labels]
        moved = np.zeros((LABELS, LABELS))
        for k in range(1, t):
            on = there[:, k]
            both = forward[on, k - 1][:, :, None] * moves[None] * (local[on, k] * back[on, k])[:, None, :]
            both /= both.sum(axis=(1, 2), keepdims=True)
            moved += both.sum(axis=0)
            np.add.at(moved, (labels[on, k - 1], labels[on, k]), -1.0)
        return (chance - truth) * there[:, :, None], moved

    def learn(self, sequences: Sequences, labels: np.ndarray, seed: int = 11, rate: float = 0.3, decay: float = 1e-5) -> None:
        """Adaptive gradient steps on the likelihood of labelled sequences, in a fixed order."""
        features, lengths = sequences.features(), np.array(sequences.lengths)
        starts = np.cumsum(lengths) - lengths
        order, r = np.argsort(lengths, kind="stable"), np.random.default_rng(seed)
        batches = [order[a : a + 64] for a in range(0, len(order), 64)]
        seen, seen_moves = np.full_like(self.weights, 1e-3), np.full_like(self.moves, 1e-3)
        for _ in range(PASSES):
            for at in r.permutation(len(batches)):
                place, there = self._padded(lengths[batches[at]], starts[batches[at]])
                found = features[place]
                gap, moved = self._gradient(self.weights[found].sum(axis=2), there, labels[place])
                index, own = found[there], gap[there]
                slots, at_slot = np.unique(index, return_inverse=True)
                total = np.zeros((len(slots), LABELS))
                np.add.at(total, at_slot.reshape(index.shape), own[:, None, :])
                total = total / len(batches[at]) + decay * self.weights[slots]
                seen[slots] += total**2
                self.weights[slots] -= rate * total / np.sqrt(seen[slots])
                moved = np.where(_allowed(), moved / len(batches[at]) + decay * self.moves, 0.0)
                seen_moves += moved**2
                self.moves -= rate * moved / np.sqrt(seen_moves)

    def decode(self, sequences: Sequences) -> np.ndarray:
        """The likeliest label of every piece, by Viterbi, sequences of like lengths together."""
        labels = np.zeros(len(sequences.codes), np.int8)
        if not len(labels):
            return labels
        features, lengths = sequences.features(), np.array(sequences.lengths)
        starts = np.cumsum(lengths) - lengths
        scores = np.zeros((len(labels), LABELS), np.float64)
        for slot in range(features.shape[1]):
            scores += self.weights[features[:, slot]]
        order, a = np.argsort(lengths, kind="stable"), 0
        while a < len(order):
            z = min(len(order), a + max(1, 100_000 // int(lengths[order[min(len(order) - 1, a + 511)]])), a + 512)
            own = order[a:z]
            place, there = self._padded(lengths[own], starts[own])
            best = scores[place[:, 0]] + self.first
            back = np.zeros((*place.shape, LABELS), np.int8)
            for k in range(1, place.shape[1]):
                ways = best[:, :, None] + self.moves[None]
                back[:, k] = ways.argmax(axis=1)
                best = np.where(there[:, k, None], ways.max(axis=1) + scores[place[:, k]], best)
            label = best.argmax(axis=1)
            for k in range(place.shape[1] - 1, -1, -1):
                on = there[:, k]
                labels[place[on, k]] = label[on]
                label = np.where(on & (k > 0), back[np.arange(len(own)), k, label], label)
            a = z
        return labels


def _plausible(kind: int, text: str) -> bool:
    """Whether a span that the field adds has the extent of its kind."""
    digits = len(_digits(text))
    if kind == 0:
        return len(text) <= 120 and bool(re.search(r"@|\bat\b", text)) and sum(c.isalpha() for c in text) >= 4
    if kind == 1:
        return 7 <= len(text) <= 45 and digits >= 4 and (text.count(".") == 3 or text.count(":") >= 2)
    return 12 <= digits <= 19 if kind == 2 else 7 <= digits <= 15


def _added(text: str, sequences: Sequences, labels: np.ndarray, a: int, z: int, base: list) -> list[tuple[int, int, int]]:
    """Spans of the labels of pieces a to z that meet none of the base."""
    out, at = [], a
    while at < z:
        label = int(labels[at])
        end = at + 1
        if label % 2:
            while end < z and labels[end] == label + 1:
                end += 1
            s, e = sequences.starts[at], sequences.ends[end - 1]
            if _plausible(label // 2, text[s:e]) and not any(s < y and x < e for _, x, y in base):
                out.append((label // 2, s, e))
        at = end
    return out


def spans(texts: list[str | None], field: Field) -> list[tuple[list, list]]:
    """(base, added) spans of every text."""
    sequences, ranges, found = Sequences(field.lexicon), [], []
    for text in texts:
        text = text or ""
        first = len(sequences.codes)
        for a, z in stretches(text):
            sequences.add(text, a, z)
        ranges.append((first, len(sequences.codes)))
        found.append(base_spans(text))
    labels = field.decode(sequences)
    return [(base, _added(text or "", sequences, labels, a, z, base) if z > a else []) for text, base, (a, z) in zip(texts, found, ranges)]


# --- the labelled table

#: Labelled sentences are made of these: a slot in braces is a value, of a kind if its name begins with one.
_CUES = {
    "email": ["mail", "e-mail", "contact", "write to", "Kontakt", "schreibe an", "courriel", "correo", "reply to"],
    "ip": ["host", "server", "address", "client", "from", "Adresse", "serveur", "servidor"],
    "card": ["card", "Visa", "Mastercard", "credit card", "Karte", "Kreditkarte", "carte", "tarjeta", "charged to"],
    "phone": ["tel", "phone", "call", "mobile", "fax", "Telefon", "Tel.", "téléphone", "teléfono", "ring"],
    "": ["version", "page", "on", "at", "order", "ticket", "year", "about", "Seite", "am", "le", "el", "total", "dot", "ISBN", "id", "room", "born"],
}
_FILLER = "the a of and to in is we she he und der die das ein mit le la les et une de y el los con que for was this that please thanks see also".split()


def _digit_run(r: random.Random, n: int) -> str:
    return "".join(r.choices("0123456789", k=n))


def _card(r: random.Random, good: bool) -> str:
    digits = _digit_run(r, r.choice([15, 16, 16, 16]))
    while luhn(digits) != good:
        digits = digits[:-1] + r.choice("0123456789")
    return digits


def _name(r: random.Random) -> str:
    return "".join(r.choice("bcdfghklmnprstvw") + r.choice("aeiouéü") for _ in range(r.randrange(1, 4))) + r.choice(["", "n", "s"])


def _personal(r: random.Random, kind: str) -> tuple[str, bool]:
    """A value of a kind, and whether it is one only behind a word that says so."""
    if kind == "email":
        local, host, end = r.choice([_name(r), f"{_name(r)}.{_name(r)}", f"{_name(r)}{r.randrange(99)}"]), _name(r), r.choice(["com", "org", "de", "fr", "example.com"])
        return r.choice([f"{local}@{host}.{end}", f"{local}(at){host}.{end}", f"{local} [at] {host} [dot] {end}", f"{local} at {host} dot {end}", f"{local}@{host}", f"{local} @ {host}.{end}", f"{local}[at]{host}.{end}"]), False
    if kind == "ip":
        four = [str(r.randrange(256)) for _ in range(4)]
        return r.choice([".".join(four), ".".join(four), " . ".join(four), ":".join("%x" % r.randrange(1, 65536) for _ in range(8)), "2001:db8::%x:%x" % (r.randrange(1, 65536), r.randrange(1, 65536))]), False
    if kind == "card":
        good = r.random() < 0.5
        d = _card(r, good)
        sep = r.choice(["", " ", "-", ".", "/"])
        return (sep.join(d[k : k + 4] for k in range(0, len(d), 4)) if sep else d), not good
    a, b, c = _digit_run(r, 3), _digit_run(r, 3), _digit_run(r, 4)
    plain = [f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{_digit_run(r, 2)} {_digit_run(r, r.choice([6, 7, 8]))}", f"0{_digit_run(r, 3)}/{_digit_run(r, 6)}", f"00{_digit_run(r, 2)} {_digit_run(r, 2)} {_digit_run(r, 7)}", f"{a}{b}{c}", f"{b}-{c}"]
    clear = [f"({a}) {b}-{c}", f"+{r.choice('123456789')} ({a}) {b}-{c}", f"+{_digit_run(r, 2)} {_digit_run(r, 3)} {_digit_run(r, 7)}", f"({a}){b}-{c}"]
    return (r.choice(clear), False) if r.random() < 0.5 else (r.choice(plain), True)


def _ordinary(r: random.Random) -> str:
    n = r.randrange
    return r.choice([
        f"{n(1900, 2030)}-{n(1, 13):02d}-{n(1, 29):02d}", f"{n(1, 29)}/{n(1, 13)}/{n(1990, 2030)}", f"{n(1, 29)}.{n(1, 13)}.{n(1990, 2030)}", f"{n(24):02d}:{n(60):02d}:{n(60):02d}", f"{n(2000, 2030)}-{n(1, 13):02d}-{n(1, 29):02d}T{n(24):02d}:{n(60):02d}",
        f"{n(10)}.{n(20)}.{n(20)}", f"v{n(10)}.{n(20)}", f"${n(1, 999)},{n(1000):03d}.{n(100):02d}", f"{n(1, 99)}.{n(1000):03d}.{n(1000):03d}", f"{n(1900, 2000)}-{n(2000, 2030)}", f"#{_digit_run(r, r.randrange(4, 9))}", _card(r, False), _digit_run(r, r.randrange(9, 22)),
        "%016x" % r.getrandbits(64), f"3.{_digit_run(r, 9)}", f"978-{n(10)}-{_digit_run(r, 2)}-{_digit_run(r, 6)}-{n(10)}", str(n(100_000)), f"{n(10)}-{n(10)}", f"{n(100, 999)}-{n(100, 999)}", f"@{_name(r)}", f"@{_name(r)} at {_name(r)}", f"{n(100)} {n(100)} {n(100)} {n(100)}",
        f"{n(1000)} | {n(1000)} | {n(1000)}", f"at {_name(r)} dot", f"{n(300, 999)}.{n(300, 999)}.{n(1000)}.{n(300, 999)}", f'"{_digit_run(r, r.randrange(5, 12))}"', f"{_name(r)} at {_name(r)}", f"{n(100)}%", f"({n(1990, 2030)})", f"{_digit_run(r, 7)}", f"{_digit_run(r, 10)}", f"{n(1, 999)}.{n(100)}",
    ])


def sentences(n: int = FIT_SENTENCES, seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """n labelled texts: (text, [(kind, start, end)])."""
    r, out = random.Random(seed), []
    for k in range(n):
        text, found = "", []
        for _ in range(r.randrange(1, 4)):
            words = [r.choice(_FILLER) if r.random() < 0.5 else _name(r) for _ in range(r.randrange(0, 7))]
            kind = r.choice(KINDS) if k % 2 else ""
            cue = [r.choice(_CUES[kind]) + r.choice(["", ":", " is", " no."])] if r.random() < 0.6 else []
            if kind:
                value, needs = _personal(r, kind)
                if needs and not cue:  # without such a word it is an ordinary number
                    kind = ""
            else:
                value = _ordinary(r)
            before = " ".join([*words, *cue])
            text += (before + " " if before else "") + r.choice(["", "", "", "(", '"'])
            if kind:
                found.append((kind, len(text), len(text) + len(value)))
            text += value + r.choice([" ", ", ", ". ", "; ", ") "])
        out.append((text + " ".join(_name(r) for _ in range(r.randrange(4))), found))
    return out


def labelled_texts(spark: SparkSession, n: int = FIT_SENTENCES) -> DataFrame:
    """The labelled table: (text, spans) of n sentences."""
    return spark.createDataFrame([(t, [{"kind": k, "start": a, "end": z} for k, a, z in found]) for t, found in sentences(n)], "text string, spans array<struct<kind:string,start:long,end:long>>")


def ordinary_texts(docs: DataFrame, documents: int = FIT_DOCS, rows: int = FIT_STRETCHES) -> DataFrame:
    """(text, spans) of at most `rows` stretches of at most about `documents` documents, those of least hash, labelled by the patterns."""

    def kernel(batches):
        for batch in batches:
            texts, found = [], []
            for text in batch.column(0).to_pylist():
                for a, z in stretches(text or "")[:20]:
                    texts.append(text[a:z])
                    found.append([{"kind": KINDS[k], "start": s, "end": e} for k, s, e in base_spans(text[a:z])])
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], names=["text", "spans"])

    code = F.xxhash64("doc_id")
    least = docs.select(code.alias("h")).orderBy("h").limit(documents).agg(F.max("h")).first()[0]
    if least is None:
        return docs.sparkSession.createDataFrame([], "text string, spans array<struct<kind:string,start:long,end:long>>")
    small_batches(docs.sparkSession)
    own = docs.where(code <= least).select("text").mapInArrow(kernel, "text string, spans array<struct<kind:string,start:long,end:long>>")
    return own.orderBy(F.xxhash64("text"), "text").limit(rows)


def fit(*labelled: DataFrame) -> Field:
    """A field that has learned from labelled tables (text, spans of kind, start, end), which must fit the driver: a few thousand short texts."""
    rows = [(r["text"], [(KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["spans"]]) for table in labelled for r in table.select("text", "spans").collect() if r["text"]]
    words = Counter(w.lower() for text, _ in rows for w in set(_PIECE.findall(text)) if w[0].isalpha())
    known = {w for group in _CUES.values() for cue in group for w in _PIECE.findall(cue.lower())} | {"at", "dot", "com", "org", "de", "fr", "localhost"}
    field = Field({w: k + 1 for k, w in enumerate(sorted(w for w in words if w in known))})
    sequences, labels = Sequences(field.lexicon), []
    for text, found in rows:
        first = len(sequences.codes)
        sequences.add(text, 0, len(text))
        own = [0] * (len(sequences.codes) - first)
        for kind, s, e in sorted(found, key=lambda f: -f[0]):
            inside = [k for k in range(len(own)) if s <= sequences.starts[first + k] < e]
            for k in inside:
                own[k] = 1 + 2 * kind + (k != inside[0])
        for k in range(len(own)):  # where a kind covers the beginning of another, what is left begins anew
            if own[k] and own[k] % 2 == 0 and (not k or own[k - 1] not in (own[k], own[k] - 1)):
                own[k] -= 1
        labels += own
    field.learn(sequences, np.array(labels, dtype=np.int64))
    return field


# --- over a table

def private_spans(docs: DataFrame, field: Field, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, if not given) of docs and `__spans`, an array of (kind, start, end, base) by kind, then start."""
    keep = docs.columns if keep is None else keep
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(field)
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep), F.lit(0)).alias("__rest"), F.col("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def kernel(batches):
        for batch in batches:
            found = spans(batch.column(1).to_pylist(), sent.value)
            every = [[{"kind": KINDS[k], "start": s, "end": e, "base": own} for k, s, e, own in sorted([(*x, True) for x in base] + [(*x, False) for x in added])] for base, added in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(every, kind)], names=["__rest", "__spans"])

    schema = given.select("__rest", F.lit(None).cast(_SPANS).alias("__spans")).schema
    return given.mapInArrow(kernel, schema).select(*(F.col("__rest").getField(c).alias(c) for c in keep), "__spans")


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """docs with each span of personal data replaced by its kind in square brackets; of spans that overlap, the one that starts first (then the longest) stands for all."""
    found = private_spans(docs, field)
    by_start = F.array_sort(F.transform("__spans", lambda x: F.struct(x["start"].alias("s"), (-x["end"]).alias("e"), x["kind"].alias("k"))))
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))
    text = F.col("text")

    def step(done, x):
        end = -x["e"]
        shown = F.concat(done["text"], F.substring(text, (done["at"] + 1).cast("int"), (x["s"] - done["at"]).cast("int")), F.lit("["), F.upper(x["k"]), F.lit("]"))
        return F.when(x["s"] >= done["at"], F.struct(shown.alias("text"), end.alias("at"))).otherwise(F.struct(done["text"].alias("text"), F.greatest(done["at"], end).alias("at")))

    out = F.aggregate(by_start, start, step, lambda done: F.concat(done["text"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))
    return found.withColumn("text", F.when(F.size("__spans") > 0, out).otherwise(text)).select(*docs.columns)


def digest_of(found: DataFrame) -> DataFrame:
    """found (doc_id, __spans) as doc_id, counts of the patterns' matches by kind, the hash of their list, the list of all spans, and how many the field added."""
    named = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("__spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(named(base), 256).alias("base_sha256"), named("__spans").alias("spans"), (F.size("__spans") - F.size(base)).cast("long").alias("n_added"))


def text_hash(text: str) -> str:
    """The hash that digest_of() gives for the base of a text."""
    return sha256(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base_spans(text)).encode()).hexdigest()
