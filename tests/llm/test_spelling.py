"""Spelling variants against brute force on edge rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tillsight.llm import spelling

from .conftest import SCHEMA


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def expected(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    words = sorted(w for w in n if len(w) >= 7 and n[w] >= 2)
    close = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(close[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return [(w, form[w], root(w), n[w], len(close[w]), n[form[w]] if form[w] else None) for w in words]


def found(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling.variants(df).collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", "k", 1, "c", "n") for i, t in rows], SCHEMA).repartition(3)


def edited(rng, w):
    k = rng.randrange(len(w))
    return rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abcdeÀéÿ") + w[k:], w[:k] + rng.choice("abcdeÀéÿ") + w[k + 1:]])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 12))) for _ in range(40)] + ["aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "q" * 70, "q" * 71, "r" * 63, "r" * 64, "r" * 65]
    rows = []
    for k in range(300):
        some = [rng.choice(base) for _ in range(30)]
        some += [edited(rng, rng.choice(base)) for _ in range(6)] + [w.upper() for w in some[:2]]
        rows.append((k, " ".join(some) + rng.choice(["", "\n12x", "-", "×÷ÀÀÀÀÀ"])))
    rows += [(300, "chained " * 1200 + "chainet " * 110 + "chaimet " * 10), (301, "ghaimet"), (302, "ghaimet"), (303, "z" * 3000), (304, ("z" * 2999 + " ") * 2), (305, "z" * 3000)]
    rows += [(None, "nullable nullable"), (None, None), (7, None), (8, ""), (9, "1234 , ."), rows[5], rows[5], (310, "😀prefixes😀prefixes ŽŽabcdefgŽ abcdefg")]
    return rows


def test_edge_rows(spark, corpus):
    got = found(frame(spark, corpus))
    assert got == expected(corpus)
    assert any(r[1] and r[2] != r[1] for r in got)      # some chain has more than one link


def test_many_shards_and_turns(spark, corpus, monkeypatch):
    for name, value in (("SHARD", 20), ("TURN_BYTES", 300), ("EDITS", 200), ("FLUSH", 50)):
        monkeypatch.setattr(spelling, name, value)
    monkeypatch.setattr(spelling.filters, "__defaults__", (20,))
    monkeypatch.setattr(spelling.turns, "__defaults__", (300,))
    few = corpus[:60]
    assert found(frame(spark, few)) == expected(few)


def test_empty_and_sparse(spark, docs, rows, no_docs):
    assert spelling.variants(no_docs).count() == 0
    assert found(docs) == expected(rows)


def test_filters_hold_their_words():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 50_000, dtype=np.uint64)
    bits = spelling.bloom(h)
    assert len(spelling.maybe(bits, h)) == len(h)
    assert len(spelling.maybe(bits, rng.integers(0, 2**63, 100_000, dtype=np.uint64))) < 500


def test_edit_hashes_are_those_of_the_edited_words():
    letters = np.frombuffer(b"abbacus", np.uint8).reshape(1, 7)
    alphabet = np.frombuffer(b"abcsu", np.uint8)
    dropped = {"bbacus", "abacus", "abbcus", "abbaus", "abbacs", "abbacu"}
    got = np.concatenate([h for _, h in spelling.edits(letters, alphabet, False)])
    assert sorted(got) == sorted(spelling.letter_hashes(list(dropped)))
    put = {"abbacus"[:k] + c + "abbacus"[k + 1:] for k in range(7) for c in "abcsu" if c > "abbacus"[k]}
    got = np.concatenate([h for _, h in spelling.edits(letters, alphabet, True)])
    assert sorted(got) == sorted(spelling.letter_hashes(list(put)))
