"""Operator 4: personal data, by fixed patterns and a character-level bidirectional LSTM with CRF transitions.

The patterns find the base spans. The model finds what they cannot: the same data written another way, such as
``ann at mail dot com``, ``10[.]0[.]0[.]1``, a card number in groups with dots, a phone number without its plus sign. It
learns from base spans of the documents, each rewritten in such ways where it stands with its tags, and from near misses
(licence numbers, dates, hexadecimal tokens, prose with "at" and "dot") put in their place. It is trained in numpy on
windows of at most ``SAMPLE`` documents, taken by hashed id, in one task, and reads each character as a class: digit, capital, small
letter, the letters of "at" and "dot", each other sign.

A span must hold a digit, an ``@`` or a spelled-out "at" or "dot" (``marks``), so windows around all marks of a text see
all that can be a span, with ``MARGIN`` characters on either side. Windows of ``WINDOW`` characters overlap by half. Each
is decoded by Viterbi; a span that a window cuts is left to its neighbour; then spans of all windows of a text are
reconciled at once: the set without overlaps, among themselves or with base spans, that has the most confidence. Spans
below ``CONFIDENCE``, or without what their kind needs (``holds``: an address, four parts up to 255, the check digit of a
card, the count of digits), are not added. Card-shaped digits are tagged whatever their check digit is, as ``holds`` tests it.

Nulls: a null text is empty and has no spans; a null ``doc_id`` is a document like others, never learned from. Without base spans
to learn from, no spans are added. Repeated rows give repeated results. An empty table gives no rows.
"""

import hashlib
import re
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, bounded_sample, slices, texts

KINDS = "email", "ip", "card", "phone"
SAMPLE = 12_000
WINDOWS = 600
WINDOW, MARGIN = 128, 28
HIDDEN, EMBEDDED = 20, 10
EPOCHS, BATCH, RATE = 6, 48, 0.03
CONFIDENCE = 0.5
SEED = 4_001

# The fixed patterns.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What a span must hold: a digit, "@", or in small letters a spelled-out at or dot.
TRIGGER = re.compile(r"[0-9@]")
SPELLED_AT = re.compile(r"at(?: ?[\])}>]| [a-z0-9-]+ ?\.[a-z])")
SPELLED_DOT = re.compile(r"dot(?![a-z])")
LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

SPELLING = "adot"
SIGNS = " \n\t.,;:!?@+-()[]{}<>/\\\"'#$%&*=_|~^`"
TAGS = 1 + 2 * len(KINDS)
CLASSES = 5 + len(SPELLING) + len(SIGNS)

FIELDS = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())
]


def emails(text):
    """Leftmost matches of the local part, ``@`` and domain: from each ``@`` back over the signs before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_SIGNS:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def count_digits(x):
    return sum("0" <= c <= "9" for c in x)


def base_spans(text):
    """(start, kind, end) of the fixed patterns, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= count_digits(m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def classes(text):
    """The class of each character; 0 is padding."""
    return np.array([_class(c) for c in text], dtype=np.int64)


def _class(c, known={c: 5 + i for i, c in enumerate(SPELLING + SIGNS)} | {c: 5 + i for i, c in enumerate(SPELLING.upper())}):
    if c in known:
        return known[c]
    if "0" <= c <= "9":
        return 1
    return (3 if c.isupper() else 2) if c.isalpha() else 4


def marks(text):
    """The places of all digits, ``@``, and spelled-out at and dot, in order."""
    low = text.lower()
    low = low if len(low) == len(text) else text
    found = [m.start() for m in TRIGGER.finditer(text)]
    spelled = [m.start() for p in (SPELLED_AT, SPELLED_DOT) for m in p.finditer(low)]
    return sorted(found + spelled) if spelled else found


def windows(text):
    """(start, end, cut before, cut after) of the windows around marks."""
    region = None
    for at in marks(text):
        a, b = max(0, at - MARGIN), min(len(text), at + 1 + MARGIN)
        if region and a <= region[1]:
            region[1] = b
        else:
            if region:
                yield from _cut(*region)
            region = [a, b]
    if region:
        yield from _cut(*region)


def _cut(a, b):
    start = a
    while True:
        end = min(b, start + WINDOW)
        yield start, end, start > a, end < b
        if end == b:
            return
        start += WINDOW // 2


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def lse(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    """Embedding, two LSTMs, and a linear-chain CRF; arrays are time, batch, feature."""

    def __init__(self, seed=SEED):
        r = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {"embed": r.normal(0, 0.3, (CLASSES, EMBEDDED))}
        for d in "fb":
            self.p |= {f"x{d}": r.normal(0, 0.3, (EMBEDDED, 4 * h)), f"h{d}": r.normal(0, 0.2, (h, 4 * h)), f"b{d}": np.zeros(4 * h)}
            self.p[f"b{d}"][h : 2 * h] = 1.0
        self.p |= {"out": r.normal(0, 0.2, (2 * h, TAGS)), "bias": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS)), "start": np.zeros(TAGS)}
        # The inside of a kind follows its beginning or its inside.
        self.barred, self.barred_start = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
        for k in range(len(KINDS)):
            self.barred[:, 2 + 2 * k] = -1e4
            self.barred[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
        self.barred_start[2::2] = -1e4

    def _lstm(self, x, d):
        h, p = HIDDEN, self.p
        z_all = x @ p[f"x{d}"] + p[f"b{d}"]
        n, b = x.shape[:2]
        hs, cs, gates = np.zeros((n + 1, b, h)), np.zeros((n + 1, b, h)), np.empty((n, b, 4 * h))
        for t in range(n):
            z = z_all[t] + hs[t] @ p[f"h{d}"]
            g = gates[t]
            g[:, : 3 * h] = sigmoid(z[:, : 3 * h])
            g[:, 3 * h :] = np.tanh(z[:, 3 * h :])
            cs[t + 1] = g[:, h : 2 * h] * cs[t] + g[:, :h] * g[:, 3 * h :]
            hs[t + 1] = g[:, 2 * h : 3 * h] * np.tanh(cs[t + 1])
        return hs, cs, gates

    def _lstm_back(self, x, d, saved, grad, grads):
        h, (hs, cs, gates) = HIDDEN, saved
        n, b = x.shape[:2]
        dh, dc, dz = np.zeros((b, h)), np.zeros((b, h)), np.empty((n, b, 4 * h))
        for t in range(n - 1, -1, -1):
            i, f, o, g = (gates[t][:, k * h : (k + 1) * h] for k in range(4))
            tc = np.tanh(cs[t + 1])
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - tc**2)
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * cs[t] * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            dc = dc * f
            dh = dz[t] @ self.p[f"h{d}"].T
        flat = dz.reshape(n * b, -1)
        grads[f"x{d}"] = x.reshape(n * b, -1).T @ flat
        grads[f"h{d}"] = hs[:-1].reshape(n * b, -1).T @ flat
        grads[f"b{d}"] = flat.sum(0)
        return (flat @ self.p[f"x{d}"].T).reshape(x.shape)

    def emissions(self, ids):
        x = self.p["embed"][ids]
        fore, back = self._lstm(x, "f"), self._lstm(x[::-1], "b")
        both = np.concatenate([fore[0][1:], back[0][1:][::-1]], axis=2)
        return both @ self.p["out"] + self.p["bias"], (x, fore, back, both)

    def _sums(self, e):
        """Forward and backward log sums, transitions and the log of all paths."""
        move = self.p["move"] + self.barred
        n, b, k = e.shape
        alpha, beta = np.empty((n, b, k)), np.zeros((n, b, k))
        alpha[0] = e[0] + self.p["start"] + self.barred_start
        for t in range(1, n):
            alpha[t] = lse(alpha[t - 1][:, :, None] + move, 1) + e[t]
        for t in range(n - 2, -1, -1):
            beta[t] = lse(move + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        return alpha, beta, move, lse(alpha[-1], 1)

    def gradients(self, ids, tags):
        """Mean negative log likelihood of the tags, and its gradients."""
        e, (x, fore, back, both) = self.emissions(ids)
        n, b, k = e.shape
        alpha, beta, move, z = self._sums(e)
        posterior = np.exp(alpha + beta - z[None, :, None])
        cols = np.arange(b)
        gold = e[np.arange(n)[:, None], cols, tags].sum(0) + self.p["start"][tags[0]] + self.p["move"][tags[:-1], tags[1:]].sum(0)
        de = posterior.copy()
        de[np.arange(n)[:, None], cols, tags] -= 1
        grads = {"start": de[0].sum(0) / b}
        dmove = np.exp(alpha[:-1, :, :, None] + move + (e[1:] + beta[1:])[:, :, None, :] - z[None, :, None, None]).sum((0, 1))
        np.subtract.at(dmove, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        grads["move"] = dmove / b
        de /= b
        grads["out"] = both.reshape(n * b, -1).T @ de.reshape(n * b, k)
        grads["bias"] = de.sum((0, 1))
        dboth = de @ self.p["out"].T
        dx = self._lstm_back(x, "f", fore, dboth[:, :, :HIDDEN], grads)
        dx = dx + self._lstm_back(x[::-1], "b", back, dboth[::-1, :, HIDDEN:], grads)[::-1]
        grads["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(grads["embed"], ids, dx)
        return float((z - gold).mean()), grads

    def decode(self, ids):
        """The best tags and their posterior probabilities."""
        e, _ = self.emissions(ids)
        alpha, beta, move, z = self._sums(e)
        posterior = np.exp(alpha + beta - z[None, :, None])
        n, b, _ = e.shape
        best, back = e[0] + self.p["start"] + self.barred_start, np.empty(e.shape, dtype=np.int64)
        for t in range(1, n):
            paths = best[:, :, None] + move
            back[t] = paths.argmax(1)
            best = np.take_along_axis(paths, back[t][:, None, :], 1)[:, 0] + e[t]
        tags = np.empty((n, b), dtype=np.int64)
        tags[-1] = best.argmax(1)
        for t in range(n - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(b), tags[t]]
        return tags, np.take_along_axis(posterior, tags[:, :, None], 2)[:, :, 0]


def padded(rows, fill=0):
    out = np.full((max(map(len, rows)), len(rows)), fill, dtype=np.int64)
    for i, x in enumerate(rows):
        out[: len(x), i] = x
    return out


def train(rows, epochs=EPOCHS, seed=SEED):
    """A tagger from (classes, tags) pairs by Adam; None if there is no span among them."""
    if not any(np.any(tags) for _, tags in rows):
        return None
    tagger, random = Tagger(seed), np.random.default_rng(seed)
    slow, fast, step = {k: np.zeros_like(v) for k, v in tagger.p.items()}, {k: np.zeros_like(v) for k, v in tagger.p.items()}, 0
    total = epochs * -(-len(rows) // BATCH)
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for first in range(0, len(rows), BATCH):
            batch = [rows[i] for i in order[first : first + BATCH]]
            _, grads = tagger.gradients(padded([a for a, _ in batch]), padded([b for _, b in batch]))
            size = np.sqrt(sum((g**2).sum() for g in grads.values()))
            step += 1
            rate = RATE * (1 - 0.9 * step / total) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (size + 1e-9))
                fast[k] = 0.9 * fast[k] + 0.1 * g
                slow[k] = 0.999 * slow[k] + 0.001 * g**2
                tagger.p[k] -= rate * fast[k] / (np.sqrt(slow[k]) + 1e-8)
    return tagger


def tagged(text, spans):
    """The tags of a text whose spans don't overlap; of overlapping ones the first holds."""
    tags = np.zeros(len(text), dtype=np.int64)
    free = 0
    for a, k, b in spans:
        if a >= free:
            tags[a:b] = 2 + 2 * k
            tags[a] = 1 + 2 * k
            free = b
    return tags


ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
AT_FORMS = re.compile(r" ?[\[({<] ?at ?[\])}>] ?| at | ?@ ?", re.I)
DOT_FORMS = re.compile(r" ?[\[({<] ?(?:dot|\.) ?[\])}>] ?| dot | ?\. ?", re.I)
PARTS = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
CARD_SHAPE = re.compile(r"[0-9]+(?:[^0-9A-Za-z]{1,3}[0-9]+)*")
PHONE_SHAPE = re.compile(r"\(?\+?[0-9][0-9 ().+/-]+[0-9]")


def holds(kind, text, a, b):
    """Whether a span has what its kind needs, and no letter or digit goes on beyond it."""
    x = text[a:b]
    if (a and text[a - 1].isalnum() and x[0].isalnum()) or (text[b : b + 1].isalnum() and x[-1].isalnum()):
        return False
    if kind == 0:
        return ADDRESS.fullmatch(DOT_FORMS.sub(".", AT_FORMS.sub("@", x))) is not None
    if kind == 1:
        plain = DOT_FORMS.sub(".", x)
        return PARTS.fullmatch(plain) is not None and all(int(p) <= 255 for p in plain.split("."))
    if kind == 2:
        digits = "".join(c for c in x if "0" <= c <= "9")
        return CARD_SHAPE.fullmatch(x) is not None and 14 <= len(digits) <= 19 and luhn(digits)
    return PHONE_SHAPE.fullmatch(x) is not None and 10 <= count_digits(x) <= 15


def window_spans(tags, sure, start, cut_before, cut_after):
    """(start, kind, end, confidence) of one decoded window, without those that it cuts."""
    n, i = len(tags), 0
    while i < n:
        if tags[i] % 2 == 0:
            i += 1
            continue
        kind, j = (tags[i] - 1) // 2, i + 1
        while j < n and tags[j] == 2 + 2 * kind:
            j += 1
        if not (cut_before and i == 0) and not (cut_after and j == n):
            yield start + i, int(kind), start + j, float(sure[i:j].min())
        i = j


def reconcile(found, base):
    """Of spans with confidences, the set without overlaps that has the most of it; none overlaps a base span."""
    best = {}
    for a, k, b, c in found:
        best[a, k, b] = max(c, best.get((a, k, b), 0))
    free = sorted(
        ((a, k, b, c) for (a, k, b), c in best.items() if all(b <= x or a >= y for x, _, y in base)), key=lambda s: (s[2], s[0], s[1])
    )
    ends = [s[2] for s in free]
    value, chosen = [0.0], [()]
    for i, (a, k, b, c) in enumerate(free):
        j = int(np.searchsorted(ends[:i], a, side="right"))
        take = value[j] + c * (b - a)
        value.append(max(value[i], take))
        chosen.append((chosen[j], (a, k, b)) if take > value[i] else chosen[i])
    out, link = [], chosen[-1]
    while link:
        link, span = link
        out.append(span)
    return out


def added_spans(tagger, texts_, bases, batch=256):
    """For each text the spans that the tagger adds to the base spans."""
    places = [(i, *w) for i, text in enumerate(texts_) for w in windows(text)]
    found = [[] for _ in texts_]
    for first in range(0, len(places), batch):
        part = places[first : first + batch]
        rows = [classes(texts_[i][a:b]) for i, a, b, _, _ in part]
        tags, sure = tagger.decode(padded(rows))
        for k, (i, a, b, before, after) in enumerate(part):
            for s in window_spans(tags[: b - a, k], sure[: b - a, k], a, before, after):
                if s[3] >= CONFIDENCE and holds(s[1], texts_[i], s[0], s[2]):
                    found[i].append(s)
    return [reconcile(f, b) for f, b in zip(found, bases, strict=True)]


def shaped_spans(text):
    """The base spans, and numbers shaped like a card whatever their check digit."""
    return sorted(set(base_spans(text)) | {(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= count_digits(m.group()) <= 19})


def _word(random, least, most):
    return "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=random.randint(least, most)))


def rewritten(kind, x, random):
    """A base span's text in a form that the patterns do not find."""
    if kind == 0:
        local, domain = x.split("@", 1)
        if random.random() < 0.5:
            local = random.choice([_word(random, 2, 9), f"{_word(random, 1, 7)}.{_word(random, 3, 9)}", f"{_word(random, 3, 8)}{random.randint(1, 99)}"])
            domain = ".".join([_word(random, 3, 10), *([_word(random, 3, 8)] if random.random() < 0.3 else []), _word(random, 2, 4)])
        at = random.choice([" at ", " [at] ", " (at) ", "(at)", "[at]", " AT ", " @ ", "{at}"])
        dot = random.choice([" dot ", " [dot] ", " (dot) ", "(dot)", "[dot]", " DOT ", " . ", ".", "[.]"])
        return local.strip(".") + at + domain.replace(".", dot)
    if kind == 1:
        return x.replace(".", random.choice([" . ", "[.]", "(.)", " dot ", "[dot]", "(dot)", " [.] "]))
    digits = "".join(c for c in x if "0" <= c <= "9")
    if kind == 2:
        sign = random.choice([".", "/", "_", "  ", " - ", " / ", ", ", "--", " . "])
        size = random.choice([4, 4, 4, 5, 6])
        return sign.join(digits[i : i + size] for i in range(0, len(digits), size))
    if len(digits) < 10:
        return "0" * (10 - len(digits)) + digits
    a, b, c = digits[:-10], digits[-10:-7], digits[-7:]
    sign = random.choice([" ", "-", ".", "/"])
    head = random.choice([f"00{a}{sign}" if len(a) < 4 else f"{a}{sign}", f"{a}{sign}" if a else "", f"({a}) " if a else ""])
    return head + random.choice([f"({b}) {c[:3]}{random.choice('-. /')}{c[3:]}", f"{b}{sign}{c[:3]}{sign}{c[3:]}"])


def near_miss(random):
    """Text that looks like personal data and is none."""
    number = lambda n: "".join(random.choices("0123456789", k=n))
    return random.choice([
        lambda: f"{_word(random, 2, 2).upper()}-{number(4)}-{number(4)}-{_word(random, 2, 2).upper()}",
        lambda: "".join(random.choices("0123456789abcdef", k=random.randint(12, 40))),
        lambda: f"20{number(2)}-{random.randint(10, 12)}-{random.randint(10, 28)} {number(2)}:{number(2)}:{number(2)}",
        lambda: f"no. {number(random.randint(3, 9))}", lambda: f"{number(1)}.{number(1)}.{number(2)}", lambda: f"{number(3)}, {number(4)}, {number(2)}, {number(3)}",
        lambda: f"ISBN 978-{number(1)}-{number(5)}-{number(3)}-{number(1)}", lambda: f"{number(2)}.{number(2)} at {number(1)} dot {number(1)}",
        lambda: f"{_word(random, 3, 8)} at the {_word(random, 3, 8)} dot", lambda: f"the dot at {_word(random, 2, 7)}. {_word(random, 2, 7)}",
        lambda: f"a dot and {_word(random, 2, 7)} at {_word(random, 2, 7)}", lambda: f"{number(2)}/{number(2)}/{number(4)}",
        lambda: f"@{_word(random, 4, 9)}", lambda: f"{number(4)}-{number(4)}", lambda: f"${number(3)},{number(3)}.{number(2)}",
    ])()


def replaced(text, spans, make):
    """The text with each span's text remade by ``make(kind, text)`` to (text, whether it is still a span); its tags."""
    out, tags, at = [], [], 0
    for a, k, b in spans:
        if a < at:
            continue
        new, stays = make(k, text[a:b])
        out += [text[at:a], new]
        tags += [0] * (a - at) + ([1 + 2 * k] + [2 + 2 * k] * (len(new) - 1) if stays else [0] * len(new))
        at = b
    return "".join([*out, text[at:]]), np.array(tags + [0] * (len(text) - at), dtype=np.int64)


def examples(rows, seed=SEED):
    """(text, tags) to learn from: each window as it is, and with its spans rewritten three times and once missed."""
    for text, spans in rows:
        random = Random(f"{seed} {text}")
        yield text, tagged(text, spans)
        if spans:
            for _ in range(3):
                yield replaced(text, spans, lambda k, x: (rewritten(k, x, random), True))
            yield replaced(text, spans, lambda k, x: (near_miss(random), False))


def whole_windows(text):
    """The windows of a text that cut no span, with their spans."""
    spans = shaped_spans(text)
    for a, b, _, _ in windows(text):
        inside = [(x - a, k, y - a) for x, k, y in spans if x < b and y > a]
        if all(x >= 0 and y <= b - a for x, _, y in inside):
            yield text[a:b], inside


def learn(documents, sample=SAMPLE):
    """The tagger, from windows of a bounded sample of documents; those with spans come first more often."""
    chosen = bounded_sample(documents.select("doc_id").dropna(), "doc_id", sample, SEED).distinct()

    def extract(batches):
        for batch in slices(batches):
            rows = [w for text in texts(batch) if TRIGGER.search(text) for w in whole_windows(text)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in rows]), pa.array([[v for s in y for v in s] for _, y in rows], pa.list_(pa.int64()))], ["window", "spans"]
                )

    place = F.pmod(F.xxhash64("window", F.lit(SEED)), F.lit(1 << 40))
    chosen_windows = (
        documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi").select("text")
        .mapInArrow(extract, "window string, spans array<long>").distinct()
        .orderBy(F.when(F.size("spans") > 0, place / 4).otherwise(place), "window").limit(WINDOWS)
    )

    def fit(batches):
        found = []
        for batch in batches:
            spans = [list(zip(x[::3], x[1::3], x[2::3], strict=True)) for x in batch.column(1).to_pylist()]
            found += zip(batch.column(0).to_pylist(), spans, strict=True)
        model = train([(classes(x), tags) for x, tags in examples(sorted(found))])
        if model:
            names = sorted(model.p)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names), pa.array([model.p[x].shape for x in names], pa.list_(pa.int64())),
                    pa.array([model.p[x].ravel() for x in names], pa.list_(pa.float64())),
                ],
                ["name", "shape", "weights"],
            )

    # At most WINDOWS rows, so one task: lost with its executor it runs again, and numpy has one thread there.
    weights = chosen_windows.coalesce(1).mapInArrow(fit, "name string, shape array<long>, weights array<double>").collect()
    if not weights:
        return None
    tagger = Tagger()
    tagger.p = {r.name: np.array(r.weights, dtype=np.float64).reshape(r.shape) for r in weights}
    return tagger


def named(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def all_spans(tagger, texts_):
    """For each text its base spans and all its spans."""
    bases = [base_spans(x) if TRIGGER.search(x) else [] for x in texts_]
    added = added_spans(tagger, texts_, bases) if tagger else [[] for _ in texts_]
    return bases, [sorted(b + a) for b, a in zip(bases, added, strict=True)]


def find(documents, tagger, keep=("doc_id",)):
    """The ``keep`` columns with the columns of ``FIELDS``; counts are of base spans."""

    def make():
        def run(batch):
            bases, spans = all_spans(tagger, texts(batch))
            counts = [pa.array([sum(k == kind for _, k, _ in b) for b in bases], pa.int64()) for kind in range(len(KINDS))]
            return [*counts, pa.array([hashlib.sha256(named(b).encode()).hexdigest() for b in bases]), pa.array(map(named, spans), pa.string())]

        return run

    return annotate(documents, FIELDS, make, keep)


def masked(text, spans):
    """The text with each span replaced by its kind in angle brackets; overlapping spans are one."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(documents, tagger):
    """``documents`` with masked texts, null where they were, and ``n_chars`` of the new text where it had a value."""
    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    # Names that no column has.
    taken, old_text, old_size = {c.lower() for c in documents.columns}, "_text", "_n_chars"
    while {old_text, old_size} & taken:
        old_text, old_size = f"_{old_text}", f"_{old_size}"
    inner = documents.withColumnsRenamed({"text": old_text, "n_chars": old_size})

    def make():
        def run(batch):
            old = batch.column(batch.schema.get_field_index(old_text)).to_pylist()
            sizes = batch.column(batch.schema.get_field_index(old_size)).to_pylist()
            _, spans = all_spans(tagger, [x or "" for x in old])
            new = [None if x is None else masked(x, s) for x, s in zip(old, spans, strict=True)]
            return pa.array(new, pa.string()), pa.array([n if n is None or x is None else len(x) for x, n in zip(new, sizes, strict=True)], pa.int64())

        return run

    keep = [c for c in inner.columns if c not in (old_text, old_size)]
    return annotate(inner, fields, make, keep, (old_text, old_size)).select(documents.columns)


def classify(documents):
    """The contract's columns for every document."""
    return find(documents, learn(documents))
