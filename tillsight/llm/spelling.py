"""Spelling variants by Bloom-guided neighbourhoods.

1. Runs of letters are counted by document, then by task, then over all documents: the vocabulary, with a 64-bit hash of
   every word that is a sum over its letters and places, so that the hash of an edited word follows from its own.
2. Blocked Bloom filters over these hashes, one shard a word length (lengths from ``LONG`` on together), cut by hash so
   that a shard holds about ``SHARD`` words. Shards are broadcast in turns of at most ``TURN_BYTES``.
3. Every word generates its edits, deletions for the shard of the length below and replacements by a later letter for
   its own; insertions are the deletions of the longer word. What no filter knows ends there. Only positives, 64-bit
   hashes, are shuffled, to joins with the vocabulary; the two words of a pair are then compared themselves, which removes
   the false positives.
4. Near words are counted and the best is chosen by aggregates; roots follow forms by pointer doubling (a form has ten
   times the occurrences, so no chain is longer than 19 and five doublings reach every root).

Edge cases: a null text has no words; a null ``doc_id`` counts as the empty string in front of the colon; repeated rows
count again; ties go by code points; empty tables give no rows; extra columns are ignored whatever their names. Texts and
words of any length are read whole: a long word's edits are generated in bounded pieces.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written
from .shingling import mix

LEAST_LETTERS, LEAST_COUNT, RATIO, SLIP = 7, 2, 10, 31
#: Lengths from here on share their shards; words of a shard; bytes of filters broadcast at once; edits probed at once.
LONG, SHARD, TURN_BYTES, EDITS = 64, 1_000_000, 32_000_000, 2_000_000
#: Filter bits a word, bits of a block and bits set a word.
BITS, BLOCK, PROBES = 16, 512, 6
#: Entries of a task's counter before it is sent on.
FLUSH = 500_000

_STEP, _SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019)
#: Upper to lower case of A-Z alone.
_LOWER = {c: c + 32 for c in range(65, 91)}


# -- vocabulary --------------------------------------------------------------------------------------------

def slipped(doc_id: int | None, word: str, slip: int = SLIP, prefix: int | None = None) -> str:
    """The word as the document has it: one letter less where ``slip`` divides the checksum of id and word."""
    h = zlib.crc32(word.encode(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()) if prefix is None else prefix)
    return word if h % slip else word[:h % len(word)] + word[h % len(word) + 1:]


def occurrences(docs: DataFrame, least: int = LEAST_LETTERS, slip: int = SLIP) -> DataFrame:
    """``word, n``, counted within tasks."""
    run_of_letters = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], schema=schema)

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                own: Counter = Counter()
                for word, n in Counter(run_of_letters.findall(text.as_py() or "")).items():
                    own[word.lower() if word.isascii() else word.translate(_LOWER)] += n
                prefix = zlib.crc32(f"{'' if i is None else i}:".encode())
                for word, n in own.items():
                    word = slipped(i, word, slip, prefix)
                    if len(word) >= least:
                        total[word] += n
                if len(total) > FLUSH:
                    yield sent()
                    total.clear()
        if total:
            yield sent()

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "word string, n long")


def _places(first: int, letters: np.ndarray) -> np.ndarray:
    """The hash share of every letter, by rows from place ``first`` on (last axis)."""
    place = np.arange(first, first + letters.shape[-1], dtype=np.uint64)
    return mix((place << np.uint64(8) | letters.astype(np.uint64)) * _STEP + _SEED)


def letter_hashes(words: list[str]) -> np.ndarray:
    return np.array([mix(_places(0, np.frombuffer(w.encode("latin-1"), np.uint8)).sum(dtype=np.uint64, keepdims=True))[0] for w in words], np.uint64)


def vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, count: int = LEAST_COUNT) -> DataFrame:
    """``word, n, length, class, h`` (a written table); ``class`` is the length up to ``LONG``."""
    total = occurrences(docs, least).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("length", pa.int32()), ("class", pa.int32()), ("h", pa.int64())])

    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            lengths = np.array([len(w) for w in words], np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(lengths), pa.array(np.minimum(lengths, LONG)), pa.array(letter_hashes(words).view(np.int64))], schema=schema)

    return written(map_batches(total, run, "word string, n long, length int, class int, h long"), "vocabulary")


def alphabet(words: DataFrame) -> np.ndarray:
    """The letters in use; the pattern of a word admits 116 at most."""
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    return np.array(sorted(ord(r.c) for r in letters.collect()), np.uint8)


# -- filters -----------------------------------------------------------------------------------------------

def _bits(h: np.ndarray, blocks: int) -> Iterator[np.ndarray]:
    """The bits of each hash, probe by probe: all in one block."""
    block = (h >> np.uint64(20)) % np.uint64(blocks) * np.uint64(BLOCK)
    more = mix(h ^ _SEED)
    for k in range(PROBES):
        yield block + (more >> np.uint64(9 * k)) % np.uint64(BLOCK)


def bloom(h: np.ndarray) -> np.ndarray:
    blocks = max(1, -(-len(h) * BITS // BLOCK))
    bits = np.zeros(blocks * BLOCK, bool)
    for at in _bits(h, blocks):
        bits[at] = True
    return np.packbits(bits, bitorder="little")


def maybe(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter may hold."""
    left = np.arange(len(h))
    blocks = len(bits) * 8 // BLOCK
    for k in range(PROBES):
        at = next(x for j, x in enumerate(_bits(h[left], blocks)) if j == k)
        left = left[(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]
    return left


def filters(words: DataFrame, shard: int = SHARD) -> tuple[DataFrame, dict[int, int], list[tuple[int, int, int]]]:
    """(``class, part, bits`` as a written table, parts of each class, (class, part, bytes) of all shards)."""
    counts = {r["class"]: r["n"] for r in words.groupBy("class").agg(F.count("*").alias("n")).collect()}
    parts = {c: -(-n // shard) for c, n in counts.items()}
    of = F.element_at(F.create_map(*[F.lit(x) for c in parts.items() for x in c]), F.col("class")) if parts else F.lit(1)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"class": rows["class"].iloc[:1], "part": rows["part"].iloc[:1], "bits": [bloom(rows["h"].to_numpy().view(np.uint64)).tobytes()]})

    table = written(words.select("class", F.pmod("h", of).cast("int").alias("part"), "h").groupBy("class", "part")
                    .applyInPandas(lambda rows: build(rows), "class int, part int, bits binary"), "filters")
    sizes = table.select("class", "part", F.octet_length("bits").alias("bytes")).orderBy("class", "part").collect()
    return table, parts, [tuple(r) for r in sizes]


def turns(sizes: list[tuple[int, int, int]], limit: int = TURN_BYTES) -> list[list[tuple[int, int]]]:
    """Shards that are broadcast together."""
    out, held = [[]], 0
    for c, p, n in sizes:
        if out[-1] and held + n > limit:
            out, held = [*out, []], 0
        out[-1].append((c, p))
        held += n
    return out


# -- edits -------------------------------------------------------------------------------------------------

def edits(letters: np.ndarray, alphabet: np.ndarray, replace: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of words, hashes) of the edits of equally long words (rows of ``letters``), in bounded pieces.

    Deletions: one of each run of equal letters. Replacements: by letters after the one replaced."""
    n, length = letters.shape
    share = _places(0, letters)
    whole = share.sum(axis=1, dtype=np.uint64)
    if not replace:
        moved = np.zeros_like(share)
        moved[:, 1:] = _places(0, letters[:, 1:])
        before = np.cumsum(share, axis=1, dtype=np.uint64) - share
        after = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
        other = np.ones(letters.shape, bool)
        other[:, 1:] = letters[:, 1:] != letters[:, :-1]
        who, at = np.nonzero(other)
        for lo in range(0, len(who), EDITS):
            w, a = who[lo:lo + EDITS], at[lo:lo + EDITS]
            yield w, mix(before[w, a] + after[w, a])
        return
    step = max(1, EDITS // max(1, n * len(alphabet)))
    for first in range(0, length, step):
        old = letters[:, first:first + step]
        new = np.stack([_places(first, np.full(old.shape[1], c, np.uint8)) for c in alphabet])
        who, at, c = np.nonzero(alphabet[None, None, :] > old[:, :, None])
        yield who, mix(whole[who] - share[who, first + at] + new[c, at])


def probed(words: DataFrame, letters: np.ndarray, shards: dict[tuple[int, int], bytes], parts: dict[int, int]) -> DataFrame:
    """``source, edit``: hashes of words and of those of their edits that a broadcast shard may hold."""
    held = words.sparkSession.sparkContext.broadcast({"shards": shards, "parts": parts, "letters": letters})
    classes = sorted({c for c, _ in shards})
    asked = words.where(F.col("class").isin(classes) | (F.col("class") - 1).isin(classes))
    schema = pa.schema([("source", pa.int64()), ("edit", pa.int64())])

    def run(batches):
        know = held.value
        bits = {k: np.frombuffer(v, np.uint8) for k, v in know["shards"].items()}
        for batch in batches:
            table = [(w.encode("latin-1"), h) for w, h in zip(batch.column("word").to_pylist(), batch.column("h").to_pylist())]
            table.sort(key=lambda x: len(x[0]))
            lengths = np.array([len(w) for w, _ in table])
            lo = 0
            while lo < len(table):
                size = int(lengths[lo])
                rows = max(1, EDITS // (size * max(1, len(know["letters"]))))
                hi = min(int(np.searchsorted(lengths, size, side="right")), lo + rows)
                text = np.frombuffer(b"".join(w for w, _ in table[lo:hi]), np.uint8).reshape(hi - lo, size)
                source = np.array([h for _, h in table[lo:hi]], np.int64)
                for replace, cls in ((False, min(size - 1, LONG)), (True, min(size, LONG))):
                    mine = [p for c, p in bits if c == cls]
                    if not mine:
                        continue
                    for who, h in edits(text, know["letters"], replace):
                        part = h.view(np.int64) % parts[cls]
                        for p in mine:
                            here = np.flatnonzero(part == p) if parts[cls] > 1 else np.arange(len(h))
                            here = here[maybe(bits[cls, p], h[here])]
                            if len(here):
                                yield pa.RecordBatch.from_arrays([pa.array(source[who[here]]), pa.array(h[here].view(np.int64))], schema=schema)
                lo = hi

    return map_batches(asked.repartition(F.xxhash64("word")).select("word", "h"), run, "source long, edit long"), held


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: every pair of near words once (a written table)."""
    table, parts, sizes = filters(words)
    letters = alphabet(words)
    found = None
    for turn in turns(sizes):
        if not turn:
            break
        rows = table.where(F.struct("class", "part").isin([F.struct(F.lit(c), F.lit(p)) for c, p in turn])) if len(sizes) != len(turn) else table
        positives, held = probed(words, letters, {(r["class"], r["part"]): bytes(r["bits"]) for r in rows.collect()}, parts)
        positives = written(positives, "positives")
        held.unpersist()
        found = positives if found is None else found.unionByName(positives)
    if found is None:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    one = words.select(F.col("h").alias("source"), "word", "n")
    two = words.select(F.col("h").alias("edit"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    exact = F.expr("levenshtein(word, near, 1) = 1")
    return written(found.join(two, "edit").join(one, "source").where(exact).select("word", "n", "near", "near_n").distinct(), "near")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form`` by pointer doubling."""
    now = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not now.where("moved").isEmpty():
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(now.drop("moved").join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return now.select("word", "root")


def variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``."""
    words = vocabulary(docs)
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("down"), "near")).alias("best"))
    enough = -F.col("best.down") >= ratio * F.col("n")
    chosen = written(words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.down")).alias("form_n")), "forms")
    ends = roots(chosen.where("form IS NOT NULL").select("word", "form"))
    return chosen.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
