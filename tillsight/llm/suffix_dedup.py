"""Suffix-array dedup: removes bytes under ``LENGTH``-byte strings that also start in an earlier document.

Suffixes that may repeat (``repeats``: windows whose anchor string occurs in several documents) are sorted in
a partial suffix array: Spark samples splitters and range-partitions the suffixes by their anchor strings; every bucket sorts its strings with multikey quicksort on eight-byte characters. Splitters lie
between different anchor strings, so equal strings meet in one bucket and no run of equals crosses a boundary.
Equal strings are neighbours after the sort; the least document of a run decides for all of them.
A slice of text that many documents share is held once a chunk, however many copies the chunk has, and exact
copies of whole documents are settled before: all their strings start in the earliest of them. Windows of an
anchor with more slices than a task may hold meet in an aggregate of Spark instead (``repeats.window_answers``).

Matches are judged on the input, never cross documents, and overlaps count. Edge cases: null texts are empty;
texts shorter than ``LENGTH`` bytes lose nothing; documents without an id come after all others and do not
remove from one another, nor do repeated rows with one id; extra columns are ignored; empty tables give none.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import map_batches, release, sized, written
from .repeats import Chunk, Kind
from .shingling import mix

LENGTH, GRAM = 50, 16
#: Bytes of text for each bucket of suffixes; splitters at most; sampled anchors a chunk and a splitter.
PART, MOST_PARTS, OF_CHUNK, OF_SPLITTER = 6_000_000, 1_000_000, 512, 8
#: Slices, and windows of differing slices, that a task sorts at a time, besides those of one anchor.
TURN, WINDOWS = 120_000, 250_000


def characters(data: np.ndarray, starts: np.ndarray, offsets, before: tuple = ()) -> np.ndarray:
    """Big-endian eight-byte characters of ``data`` at every start plus each of the offsets, a column an offset, after
    the columns ``before``."""
    eight = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    out = np.empty((len(starts), len(before) + len(offsets)), np.uint64, "F")
    for k, column in enumerate(before):
        out[:, k] = column
    for k, o in enumerate(offsets, len(before)):
        out[:, k] = eight[starts + o]
    return out


def multikey_sort(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): sorted by the first character, then only the rows that are still equal by the next one, and
    so on; ``group`` numbers the sorted rows so that equal rows share a number."""
    n = len(chars)
    order, group = np.arange(n), np.zeros(n, np.int64)
    open_ = np.arange(n)
    for d in range(chars.shape[1]):
        if not len(open_):
            break
        c = chars[order[open_], d]
        s = np.lexsort((c, group[open_]))
        order[open_], c, g = order[open_][s], c[s], group[open_]
        new = np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])]
        start = open_[np.flatnonzero(new)]
        group[open_] = start[np.cumsum(new) - 1]
        size = np.diff(np.r_[np.flatnonzero(new), len(open_)])
        open_ = open_[np.repeat(size > 1, size)]
    return order, group


@dataclass
class Slices:
    """Different slices of text at repeated anchors: anchor hash, least and largest document, size, the text of all
    in a row, number of places and the places of all in a row (starts of the slices in their chunk)."""
    key: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray
    text: np.ndarray
    count: np.ndarray
    place: np.ndarray

    def take(self, rows: np.ndarray) -> Slices:
        return Slices(self.key[rows], self.low[rows], self.high[rows], self.size[rows], self.text[ranges(self.size, rows)],
                      self.count[rows], self.place[ranges(self.count, rows)])

    def packed(self) -> bytes:
        head = struct.pack("<3Q", len(self.key), len(self.text), len(self.place))
        count = struct.pack("<Q", len(self.key))  # before the compressed bytes, to be read without them
        parts = (self.key.astype("<u8"), self.low.astype("<i8"), self.high.astype("<i8"), self.size.astype("<u2"), self.count.astype("<u4"),
                 self.place.astype("<i8"), self.text)
        return count + zstandard.ZstdCompressor(level=1).compress(head + b"".join(x.tobytes() for x in parts))

    @staticmethod
    def count_of(data: bytes) -> int:
        return struct.unpack_from("<Q", data)[0]

    @staticmethod
    def unpacked(data: bytes) -> Slices:
        data = zstandard.ZstdDecompressor().decompress(memoryview(data)[8:])
        n, n_text, n_place = struct.unpack_from("<3Q", data)
        out, at = [], 24
        for kind, k in (("<u8", n), ("<i8", n), ("<i8", n), ("<u2", n), ("<u4", n), ("<i8", n_place), ("u1", n_text)):
            out.append(np.frombuffer(data, kind, k, at))
            at += out[-1].nbytes
        key, low, high, size, count, place, text = out
        return Slices(key, low, high, size.astype(np.int64), text, count.astype(np.int64), place)


def leads(data: np.ndarray, anchors: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The anchor strings at the given places, comparable as bytes."""
    return np.ndarray((len(data) - gram + 1,), f"S{gram}", data, strides=(1,))[anchors]


def ranges(sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Indices of the elements of the given rows in an array that holds ``sizes`` elements a row, row after row."""
    begin, n = (np.cumsum(sizes) - sizes)[rows], sizes[rows]
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def chunk_slices(chunk: Chunk, masks: list[dict], buckets: int, kind: Kind) -> tuple[Slices, np.ndarray]:
    """The chunk's different slices at repeated anchors, and the anchor string of each of them."""
    sym, r = repeats.repeated_runs(chunk, masks, buckets, kind)
    raw = b"".join(chunk.texts) + b"\0" * (2 * kind.length)
    data, size = np.frombuffer(raw, np.uint8), r.last - r.first + kind.length
    _, first, where, count = np.unique(repeats.marks(sym, r.first, size, r.key, kind), return_index=True, return_inverse=True, return_counts=True)
    doc = repeats.order_of(chunk)[r.doc] if len(chunk.ids) else np.zeros(0, np.int64)
    low, high = np.full(len(first), repeats.NO_ID), np.full(len(first), -2**63)
    np.minimum.at(low, where, doc)
    np.maximum.at(high, where, doc)
    n = size[first]
    text = np.frombuffer(b"".join(raw[a:a + k] for a, k in zip(r.first[first].tolist(), n.tolist())), np.uint8)
    place = r.first[np.argsort(where, kind="stable")]
    return Slices(r.key[first], low, high, n, text, count, place), leads(data, r.anchor[first], kind.gram)


def sampled_splitters(table: DataFrame, kind: Kind, parts: int) -> np.ndarray:
    """Quantiles of the anchor strings in a sample of chunks that grows with ``parts``: eight strings a splitter."""
    sample = max(32, -(-parts * OF_SPLITTER // OF_CHUNK))
    schema = pa.schema([("lead", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                chunk = Chunk.unpacked(data.as_py())
                anchors = repeats.runs(*repeats.symbols(chunk, kind), kind).anchor
                text = b"".join(chunk.texts)
                lead = [text[x:x + kind.gram] for x in anchors[::max(1, len(anchors) // OF_CHUNK)][:OF_CHUNK].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(lead, pa.binary())], schema=schema)

    chosen = table.orderBy(F.xxhash64("chunk")).limit(sample).select("chunk")
    got = map_batches(table.join(F.broadcast(chosen), "chunk").select("data"), run, "lead binary").collect()  # at most MOST_PARTS * OF_SPLITTER strings
    lead = np.sort(np.array([bytes(r["lead"]) for r in got], f"S{kind.gram}"))
    return np.unique(lead[np.linspace(0, len(lead) - 1, parts + 1).astype(int)[1:-1]]) if len(lead) else lead


def decide(s: Slices, length: int = LENGTH, most: int = WINDOWS) -> tuple[np.ndarray, ...]:
    """(row, first, last, least): intervals of a slice's windows whose string starts in the document ``least``, for
    slices that a larger document holds too."""
    n = len(s.key)
    width = -(-int(s.size.max()) // 8) * 8
    padded = np.zeros((n, width), np.uint8)
    padded[np.repeat(np.arange(n), s.size), np.arange(len(s.text)) - np.repeat(np.cumsum(s.size) - s.size, s.size)] = s.text
    data, base = padded.ravel(), np.arange(n) * width
    order, group = multikey_sort(characters(data, base, range(0, width, 8), (s.key, s.size)))
    same = np.empty(n, np.int64)
    same[order] = group
    least = np.full(n, repeats.NO_ID)
    np.minimum.at(least, same, s.low)
    least = least[same]
    _, head, of_head = np.unique(same, return_index=True, return_inverse=True)  # the different slices
    _, of_key, variants = np.unique(s.key[head], return_inverse=True, return_counts=True)
    alone = (variants[of_key] == 1)[of_head]
    rows = np.flatnonzero(alone & (s.high > least))
    out = [(rows, np.zeros(len(rows), np.int64), s.size[rows] - length, least[rows])]
    # anchors with several slices: sort the strings of all windows of their different slices, whole anchors at a time
    several = np.flatnonzero(variants[of_key] > 1)
    several = several[np.argsort(of_key[several], kind="stable")]
    windows = s.size[head[several]] - length + 1
    edge = np.r_[True, of_key[several][1:] != of_key[several][:-1]] if len(several) else np.zeros(0, bool)
    turn = (np.cumsum(windows) // most)[np.maximum.accumulate(np.where(edge, np.arange(len(several)), 0))] if len(several) else np.zeros(0, np.int64)
    found = []
    for t in np.unique(turn):
        mine, k = several[turn == t], windows[turn == t]
        owner = np.repeat(head[mine], k)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(k) - k, k)
        offsets = [*range(0, length - 8, 8), length - 8]
        order, group = multikey_sort(characters(data, base[owner] + at, offsets, (s.key[owner],)))
        best = np.full(len(owner), repeats.NO_ID)
        np.minimum.at(best, group, least[owner[order]])
        least_of = np.empty(len(owner), np.int64)
        least_of[order] = best[group]
        cut = np.flatnonzero(np.r_[True, (least_of[1:] != least_of[:-1]) | (owner[1:] != owner[:-1])])
        last = np.r_[cut[1:], len(owner)] - 1
        found.append((np.repeat(mine, k)[cut], at[cut], at[last], least_of[cut]))
    if found:
        of, first, last, best = (np.concatenate(x) for x in zip(*found))
        by = np.argsort(of, kind="stable")
        of, first, last, best = of[by], first[by], last[by], best[by]
        rows = np.flatnonzero(~alone)
        lo, hi = np.searchsorted(of, of_head[rows], "left"), np.searchsorted(of, of_head[rows], "right")
        row = np.repeat(rows, hi - lo)
        pick = np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo) + np.arange(len(row))
        use = best[pick] < s.high[row]
        out.append((row[use], first[pick][use], last[pick][use], best[pick][use]))
    return tuple(np.concatenate(x) for x in zip(*out))


def answers_of(rows: pd.DataFrame, length: int = LENGTH, turn: int = TURN) -> pd.DataFrame:
    """Answers of one bucket: rows ``chunk, blob`` in, binaries of intervals by chunk out.

    Equal strings have equal anchors, so the bucket is sorted in turns by anchor hash: of all blobs a turn holds only its
    share of the slices, however large the bucket.
    """
    blobs, chunks = rows["blob"].to_numpy(), rows["chunk"].to_numpy(np.int64)
    turns = max(1, -(-sum(Slices.count_of(b) for b in blobs) // turn))
    out = []
    for t in range(turns):
        out.append(one_turn(blobs, chunks, np.uint64(t), np.uint64(turns), length))
        release()
    return pd.concat(out, ignore_index=True)


def one_turn(blobs: np.ndarray, chunks: np.ndarray, t: np.uint64, turns: np.uint64, length: int) -> pd.DataFrame:
    parts, sizes = [], []
    for b in blobs:
        p = Slices.unpacked(b)
        parts.append(p if turns == 1 else p.take(np.flatnonzero(mix(p.key) % turns == t)))
        sizes.append(len(parts[-1].key))
    s = Slices(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("key", "low", "high", "size", "text", "count", "place")))
    del parts
    if not len(s.key):
        return pd.DataFrame({"chunk": np.zeros(0, np.int64), "answer": []})
    chunk = np.repeat(chunks, sizes)
    row, first, last, least = decide(s, length)
    n = s.count[row]
    place = s.place[ranges(s.count, row)]
    data = np.empty(len(place), repeats.ANSWER)
    data["first"], data["last"], data["least"] = place + np.repeat(first, n), place + np.repeat(last, n), np.repeat(least, n)
    owner = np.repeat(chunk[row], n)
    order = np.argsort(owner, kind="stable")
    data, owner = data[order], owner[order]
    cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else np.zeros(1, np.int64)
    return pd.DataFrame({"chunk": owner[cut[:-1]], "answer": [zstandard.ZstdCompressor(level=1).compress(data[x:y].tobytes()) for x, y in zip(cut, cut[1:])]})


def removed(chunk: Chunk, answer: np.ndarray, length: int = LENGTH) -> list[tuple[np.ndarray, bytes]]:
    """For every document the mask of its removed bytes, and the text."""
    counts = np.array([len(t) for t in chunk.texts], np.int64)
    starts = np.cumsum(counts) - counts
    order = repeats.order_of(chunk)
    doc = np.searchsorted(starts + counts, answer["first"], side="right")
    hit = answer[order[doc] > answer["least"]]
    edge = np.zeros(int(counts.sum()) + 1, np.int64)
    np.add.at(edge, hit["first"], 1)
    np.add.at(edge, hit["last"] + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return [(gone[s:s + n], t) for s, n, t in zip(starts, counts, chunk.texts)]


OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                 ("kept_sha256", pa.string()), ("kept", pa.binary())])


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_kept: bool = True, most: int = repeats.MANY) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and the ``kept`` bytes)."""
    kind = Kind(length, gram, False)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("sha", F.sha2("text", 256))
    first = written(texts.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
                    .select(F.col("sha").alias("_sha"), "first"), "firsts")
    marked = texts.join(sized(first), F.col("sha") == F.col("_sha"), "left")
    # every string of a copy starts in the earliest document with its text as well
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.col("first").isNotNull())
    n = F.octet_length("text").cast("long")
    whole = n >= length
    none = F.lit(0).cast("long")
    copies = marked.where(copy).select(
        "doc_id", n.alias("n_bytes"), F.when(whole, n).otherwise(none).alias("n_removed"), F.when(whole, F.lit(1).cast("long")).otherwise(none).alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(whole, F.lit("")).otherwise(F.col("text")).cast("binary").alias("kept"))

    table = repeats.chunks(marked.where(~copy).select("doc_id", "text"))
    total = table.agg(F.sum("n_bytes")).first()[0] or 0
    masks, buckets, many = repeats.repeated_anchors(table, kind, most)
    parts = min(max(32, -(-total // PART)), MOST_PARTS)
    splitters = sampled_splitters(table, kind, parts)
    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("blob", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, data, m in zip(batch.column("chunk").to_pylist(), batch.column("data"), batch.column("masks").to_pylist()):
                s, lead = chunk_slices(Chunk.unpacked(data.as_py()), m, buckets, kind)
                part = np.searchsorted(splitters, lead, side="right")
                rows = []
                for p in np.unique(part):
                    rows.append((int(p), c, s.take(np.flatnonzero(part == p)).packed()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)
                    del s, lead, part, rows
                    release()

    suffixes = map_batches(table.select("chunk", "data").join(masks, "chunk"), send, "part int, chunk long, blob binary")
    answers = suffixes.groupBy("part").applyInPandas(lambda rows: answers_of(rows, length), "chunk long, answer binary")
    answers = written(answers.union(repeats.window_answers(table, masks, buckets, kind)) if many else answers, "answers")

    def apply(chunk: Chunk, answer: np.ndarray) -> list[tuple]:
        rows = []
        for i, (gone, text) in zip(chunk.ids, removed(chunk, answer, length)):
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
            rows.append((i, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
        return rows

    out = repeats.answered(table, answers, apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary", OUT)
    out = out.union(copies)
    return out if with_kept else out.drop("kept")
