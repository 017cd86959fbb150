"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

Patterns (e-mail, IP, card, phone) are found over the whole text, leftmost and non-overlapping per kind.
The semi-Markov CRF then scores candidate segments of up to ``LONGEST`` neighbouring tokens by features of
the whole span (shape, length, digit groups, checksum, the words before it); a dynamic program over
segmentations chooses boundaries and types together. Only tokens with a digit or an ``@`` can carry an
entity, so a text is decoded in stretches around those tokens: outside them every segmentation is the same,
which makes the decoding exact for texts of any length.

The model is trained here (``fit``): stretches of a bounded sample of documents, labelled by the patterns and
by quoted ``key = "value"`` secrets, plus variants of those spans with the context changed or a part of the
format lost (no country code, spaced digits), so that span features rather than one exact format decide.

Edge cases: a null or empty text has no spans; repeated rows and null ids pass row by row; extra columns are
ignored; an empty sample gives a model without weights, which adds nothing.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

KINDS = ["email", "ip", "card", "phone", "secret"]
BASE = KINDS[:4]
LONGEST, CONTEXT = 4, 3
#: Documents of the training sample at most, and stretches taken from them.
SAMPLE_DOCS, SAMPLE_STRETCHES = 600, 1500

# Patterns and limits of the base contract.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(r"\b(?:token|key|secret|password)\s?[=:]\s?\"([A-Za-z0-9_+/=-]{16,})\"", re.I)


def luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(twice)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start and kind order."""
    out = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if any(c in text for c in "0123456789"):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                out.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            digits = re.sub(r"[\x20-]", "", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# -- stretches and features ------------------------------------------------------------------------------

PART = re.compile(r"[^\s\"'&*$%#!,;<>]")
TOKEN = re.compile(PART.pattern + "+")
TRIGGER = re.compile(r"[0-9@]")
#: Characters of a segment of several tokens, and tokens of a stretch that are read before its settled part is given out.
TOKEN_MAX, TURN = 128, 256


def stretches(text: str) -> Iterator[Iterator[tuple[int, int]]]:
    """Runs of tokens around trigger tokens, each to be read to its end: up to ``CONTEXT`` plain tokens before the
    first one, and on until more than ``LONGEST`` plain tokens have passed. Tokens are whole, runs of any length."""
    seen = 0
    while hit := TRIGGER.search(text, seen):
        start, end = hit.start(), [hit.end()]
        while start > seen and PART.match(text, start - 1):
            start -= 1
        yield _stretch(text, max(seen, start - 60), hit.start(), end)
        seen = end[0]


def _stretch(text: str, lo: int, hit: int, end: list[int]) -> Iterator[tuple[int, int]]:
    """Tokens of one run; ``end`` becomes the end of its last trigger token."""
    before, plain = deque(maxlen=CONTEXT), 0
    for m in TOKEN.finditer(text, lo):
        if m.end() <= hit:
            before.append(m.span())
            continue
        yield from before
        before.clear()
        if TRIGGER.search(text, *m.span()):
            plain, end[0] = 0, m.end()
        else:
            plain += 1
        if plain > LONGEST:
            return
        yield m.span()


def _shape(s: str) -> str:
    out = []
    for c in s[:40]:
        k = "9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


def segment_features(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> list[str]:
    """Features of the whole span of tokens i to j-1."""
    s = text[tokens[i][0]:tokens[j - 1][1]]
    digits = [c for c in s if c.isdigit()]
    n, before = len(digits), text[tokens[i - 1][0]:tokens[i - 1][1]].lower() if i else "^"
    groups = [len(g) for g in re.findall(r"[0-9]+", s)]
    out = [f"shape={_shape(s)}", f"tokens={j - i}", f"digits={min(n, 20)}", f"rate={round(10 * n / len(s))}",
           f"long={min(len(s) // 4, 12)}", f"groups={','.join(map(str, groups[:6]))}" if len(groups) > 1 else "onegroup",
           f"before={before if before in KEYWORDS else _shape(before)}"]
    if re.fullmatch(r"[0-9a-fA-F]{24,}", s) and 0 < n < len(s):
        out.append("hex")
    if 14 <= n <= 19 and re.fullmatch(r"[0-9]([\x20-]?[0-9])+", s):
        out.append("luhn" if luhn("".join(digits)) else "notluhn")
    if re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", s):
        out.append("quad" if all(int(p) <= 255 for p in s.split(".")) else "notquad")
    if "@" in s:
        out.append("at" if re.fullmatch(r"[^@\s]+@[^@\s]+\.[A-Za-z]{2,}", s) else "notat")
    if re.fullmatch(r"(\+[0-9]{1,3}\s?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", s):
        out.append("ten")
    return out


KEYWORDS = {"token", "key", "secret", "password", "=", ":", "tel", "phone", "call", "mail", "card", "ip"}


def starting(text: str, tokens: list[tuple[int, int]], i: int) -> Iterator[tuple[int, list[str]]]:
    """(j, features) of the segments i to j-1 of up to ``LONGEST`` tokens on one line that begin and end with a digit
    or ``@``; a single token may have any length."""
    if not TRIGGER.search(text, *tokens[i]):
        return
    for j in range(i + 1, min(i + LONGEST, len(tokens)) + 1):
        a, b = tokens[i][0], tokens[j - 1][1]
        if (j > i + 1 and b - a > TOKEN_MAX) or text.find("\n", a, b) >= 0:
            break
        if TRIGGER.search(text, *tokens[j - 1]):
            yield j, segment_features(text, tokens, i, j)


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, list[str]]]:
    return [(i, j, f) for i in range(len(tokens)) for j, f in starting(text, tokens, i)]


# -- model -----------------------------------------------------------------------------------------------

class Model:
    """Weights of (feature, kind); a segment's score is their sum, a plain token scores 0."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        self.weights = weights or {}

    def scores(self, features: list[str]) -> np.ndarray:
        out = np.zeros(len(KINDS))
        for f in features:
            if f in self.weights:
                out += self.weights[f]
        return out + self.weights.get("bias", -8.0)

    def decode(self, text: str, tokens: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
        """(start, end, kind) of the best segmentation of a stretch, read token by token: best[j] is the score of the
        first j. What all open paths share is given out every ``TURN`` tokens, so a long run holds only its tail."""
        held, best, back, floor, i = [], [0.0], [None], 0, 0
        tokens = iter(tokens)
        while True:
            for t in islice(tokens, LONGEST - (len(held) - i)):
                held.append(t)
                best.append(-math.inf)
                back.append(None)
            if i == len(held):
                yield from self._path(held, back, i, floor)
                return
            if best[i] >= best[i + 1]:
                best[i + 1], back[i + 1] = best[i], None
            for j, f in starting(text, held, i):
                s = self.scores(f)
                k = int(s.argmax())
                if best[i] + s[k] > best[j]:
                    best[j], back[j] = best[i] + s[k], (i, k)
            i += 1
            if i >= TURN and i % TURN == 0:
                ends = {q for q in range(i, len(best)) if best[q] > -math.inf}
                while len(ends) > 1:
                    q = max(ends)
                    ends = ends - {q} | {back[q][0] if back[q] else q - 1}
                p = max(ends.pop(), floor)
                yield from self._path(held, back, p, floor)
                drop = max(p - 1, 0)  # the token before stays, as a feature reads it
                held, best, floor, i = held[drop:], best[drop:], p - drop, i - drop
                back = [(b[0] - drop, b[1]) if b else None for b in back[drop:]]

    @staticmethod
    def _path(held: list, back: list, j: int, floor: int) -> list[tuple[int, int, str]]:
        out = []
        while j > floor:
            if back[j] is None:
                j -= 1
            else:
                out.append((held[back[j][0]][0], held[j - 1][1], KINDS[back[j][1]]))
                j = back[j][0]
        return out[::-1]


def _expected(model: Model, n: int, segments) -> tuple[float, list[np.ndarray]]:
    """Log partition function and each segment's marginal probability by kind (forward and backward)."""
    scored = [model.scores(f) for _, _, f in segments]
    ends, starts = {}, {}
    for k, (i, j, _) in enumerate(segments):
        ends.setdefault(j, []).append(k)
        starts.setdefault(i, []).append(k)
    fwd, bwd = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        fwd[j] = np.logaddexp.reduce([fwd[j - 1], *[fwd[segments[k][0]] + np.logaddexp.reduce(scored[k]) for k in ends.get(j, [])]])
    for i in range(n - 1, -1, -1):
        bwd[i] = np.logaddexp.reduce([bwd[i + 1], *[bwd[segments[k][1]] + np.logaddexp.reduce(scored[k]) for k in starts.get(i, [])]])
    return fwd[n], [np.exp(fwd[i] + s + bwd[j] - fwd[n]) for (i, j, _), s in zip(segments, scored)]


def train(examples: list[tuple[int, list, dict[tuple[int, int], int]]], epochs: int = 12, rate: float = 0.5, l2: float = 1e-4) -> Model:
    """AdaGrad on the conditional likelihood. An example has its token count, segments and gold {(i, j): kind}."""
    weights: dict[str, np.ndarray] = {"bias": np.full(len(KINDS), -2.0)}
    model, square, rng = Model(weights), {}, random.Random(7)
    for _ in range(epochs):
        rng.shuffle(examples)
        for n, segments, gold in examples:
            _, marginals = _expected(model, n, segments)
            step: dict[str, np.ndarray] = {}
            for (i, j, features), m in zip(segments, marginals):
                g = -m
                if (i, j) in gold:
                    g[gold[i, j]] += 1
                if np.abs(g).max() > 1e-3:
                    for f in [*features, "bias"]:
                        step[f] = step.get(f, 0) + g
            for f, g in step.items():
                w = weights.setdefault(f, np.zeros(len(KINDS)))
                g = g - l2 * w
                square[f] = square.get(f, 1e-6) + g * g
                w += rate * g / np.sqrt(square[f])
    return model


def gold_spans(text: str) -> list[tuple[int, int, str]]:
    """Pattern spans and quoted secrets, without overlaps (earliest, then longest)."""
    found = base_spans(text) + [(*m.span(1), "secret") for m in SECRET.finditer(text)]
    out, end = [], 0
    for a, b, k in sorted(found, key=lambda s: (s[0], -s[1])):
        if a >= end:
            out.append((a, b, k))
            end = b
    return out


def _variant(text: str, spans: list[tuple[int, int, str]], rng: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """The same text with spans rewritten: context words lost or a part of the format changed."""
    out, places, at = "", [], 0
    for a, b, k in spans:
        out += text[at:a]
        s = text[a:b]
        if k == "phone" and rng.random() < 0.6:
            s = re.sub(r"^\+[0-9]{1,3}[\x20.-]?", "", s)
        elif k == "card" and rng.random() < 0.5 and len(s) == 16:
            s = rng.choice(" -").join(s[i:i + 4] for i in range(0, 16, 4))
        elif k == "secret" and rng.random() < 0.6:
            out = re.sub(r"\w+\s?[=:]\s?\"$", "", out)
        places.append((len(out), len(out) + len(s), k))
        out += s
        at = b
    return out + text[at:], places


def examples_of(text: str, spans: list[tuple[int, int, str]]):
    for tokens in map(list, stretches(text)):
        segments = candidates(text, tokens)
        if not segments:
            continue
        by_place = {(tokens[i][0], tokens[j - 1][1]): (i, j) for i, j, _ in segments}
        gold = {by_place[a, b]: KINDS.index(k) for a, b, k in spans if (a, b) in by_place}
        yield len(tokens), segments, gold


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_stretches: int = SAMPLE_STRETCHES) -> Model:
    """Train on windows around the trigger characters of at most ``sample_docs`` documents, chosen by a hash of the text."""
    window = F.regexp_extract_all("text", F.lit(r"(?s)(.{0,80}[0-9@][^\s]{4,60}(?:.{0,60}))"), F.lit(1))
    texts = (docs.where(F.col("text").rlike(r"[0-9]{6}|@|\+[0-9]|[0-9]\.[0-9]")).select(F.slice(window, 1, 4).alias("w"), F.xxhash64("text").alias("h"))
             .distinct().orderBy("h").limit(sample_docs).collect())
    rng, out = random.Random(11), []
    for text in sorted({w for row in texts for w in row["w"]}):
        spans = gold_spans(text)
        for t, s in ((text, spans), *([_variant(text, spans, rng)] if spans else [])):
            out += examples_of(t, s)
    return train(out[:sample_stretches])


def find(text: str, model: Model) -> list[tuple[int, int, str]]:
    """Base spans, and the model's spans that touch none of them; by start, then kind."""
    base = base_spans(text)
    out, end, starts = list(base), 0, [a for a, _, _ in base]
    reach = list(accumulate((b for _, b, _ in base), max))
    for tokens in stretches(text):
        for a, b, kind in model.decode(text, tokens):
            k = bisect_left(starts, b)  # the base spans that start before b
            if not (k and reach[k - 1] > a) and a >= end:
                out.append((a, b, kind))
                end = b
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


SCHEMA = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in BASE], ("base_sha256", pa.string()),
                    ("spans", pa.string()), ("n_added", pa.int64())])


def detect(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, the counts of the base kinds, the digest of the base spans, and all spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column("text"):
                text = t.as_py() or ""
                base = base_spans(text)
                spans = find(text, model) if TRIGGER.search(text) else base
                count = [sum(k == kind for _, _, k in base) for kind in BASE]
                rows.append((*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans) - len(base)))
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, f.type) for c, f in zip(cols, list(SCHEMA)[1:])]], schema=SCHEMA)

    kinds = ", ".join(f"n_{k} long" for k in BASE)
    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, f"doc_id long, {kinds}, base_sha256 string, spans string, n_added long")


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span (overlapping ones as one) replaced by its kind in brackets."""
    out, at = [], 0
    for a, b, k in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with their personal data masked; other columns unchanged."""
    names, place = docs.columns, docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = [t.as_py() for t in batch.column(place)]
            texts = [masked(t, find(t, model)) if t and TRIGGER.search(t) else t for t in texts]
            cols = [pa.array(texts, pa.string()) if k == place else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return map_batches(docs, run, docs.schema)
