"""Shared steps of the two exact-repeat operators: which windows of ``length`` symbols occur more than once.

Documents are packed into chunks (whole documents, about ``CHUNK`` bytes, compressed, written once).

Every window has an anchor: of the ``gram``-symbol strings in it, the one with the least hash, the leftmost of
equals. Equal windows have equal anchors at the same place in them, so windows can only repeat if their anchor
does. Neighbouring windows mostly share an anchor; such a run of windows is handled as one slice of text.

1. ``repeated_anchors``: each chunk sends the distinct hashes of its anchors to buckets of the hash range; a
   bucket answers every chunk with one bit for each hash: seen elsewhere or not. A string that a third of all
   documents share sends one hash a chunk.
2. ``slices``: each chunk sends the text of its runs at repeated anchors, equal slices once, with the places.
   The operators decide with these exact strings which windows repeat and answer with intervals of places.
3. ``window_answers``: anchors with more than ``MANY`` slices (counted once a chunk in step 1) are in no slice of
   step 2; each chunk sends their different windows, and Spark aggregates the exact strings.
4. ``answered``: every chunk gets its intervals back and applies them to its documents.

The hashes of step 1 only select; a chance collision costs work, not correctness.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, release, small, written
from .shingling import mix, window_hashes, word_hashes

CHUNK, SEGMENT, BUCKET = 2_000_000, 1 << 16, 6_000_000
#: Slices of one anchor (equal ones of a chunk once) that one task may hold; beyond them Spark aggregates its windows.
MANY = 10_000
#: Documents without an id come after all others.
NO_ID = 2**63 - 1


@dataclass(frozen=True)
class Kind:
    """Windows of ``length`` symbols, anchors of ``gram`` symbols; symbols are bytes or words."""
    length: int
    gram: int
    words: bool


# -- chunks ----------------------------------------------------------------------------------------------

@dataclass
class Chunk:
    ids: list
    texts: list[bytes]

    def packed(self) -> bytes:
        n = len(self.ids)
        head = struct.pack(f"<I{n}q{n}B{n}Q", n, *[i or 0 for i in self.ids], *[i is not None for i in self.ids], *map(len, self.texts))
        return zstandard.ZstdCompressor(level=1).compress(head + b"".join(self.texts))

    @staticmethod
    def unpacked(data: bytes) -> Chunk:
        data = zstandard.ZstdDecompressor().decompress(data)
        n, = struct.unpack_from("<I", data)
        got = struct.unpack_from(f"<{n}q{n}B{n}Q", data, 4)
        ids = [i if known else None for i, known in zip(got[:n], got[n:2 * n])]
        at, texts = 4 + 17 * n, []
        for size in got[2 * n:]:
            texts.append(data[at:at + size])
            at += size
        return Chunk(ids, texts)


def chunks(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """``chunk, n_bytes, data`` (a written table)."""
    schema = pa.schema([("chunk", pa.int64()), ("n_bytes", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, c, held = TaskContext.get().partitionId(), 0, Chunk([], []), 0

        def close():
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | k]), pa.array([held]), pa.array([c.packed()], pa.binary())], schema=schema)

        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = (t.as_py() or "").encode()
                if held and held + len(text) > size:
                    yield close()
                    k, c, held = k + 1, Chunk([], []), 0
                c.ids.append(i)
                c.texts.append(text)
                held += len(text)
        if c.ids:
            yield close()

    return written(map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "chunk long, n_bytes long, data binary"), "chunks")


# -- anchors ---------------------------------------------------------------------------------------------

@dataclass
class Runs:
    """Runs of windows with one anchor: first and last window start, anchor place, its hash, its document's place."""
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    key: np.ndarray
    doc: np.ndarray


def symbols(chunk: Chunk, kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all documents in a row, their counts)."""
    if not kind.words:
        return np.frombuffer(b"".join(chunk.texts), np.uint8), np.array([len(t) for t in chunk.texts], np.int64)
    each = [word_hashes(t.decode()) for t in chunk.texts]
    return np.concatenate([np.zeros(0, np.uint64), *each]), np.array([len(h) for h in each], np.int64)


def gram_hashes(sym: np.ndarray, kind: Kind) -> np.ndarray:
    if kind.words:
        return window_hashes(sym, kind.gram)
    n, out = len(sym) - kind.gram + 1, None
    eight = np.ndarray((len(sym) - 7,), "<u8", np.ascontiguousarray(sym), strides=(1,))
    for k in range(0, kind.gram, 8):
        part = eight[k:k + n] * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        out = part if out is None else (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + part
    return mix(out)


def runs(sym: np.ndarray, counts: np.ndarray, kind: Kind) -> Runs:
    n, width = len(sym) - kind.length + 1, kind.length - kind.gram + 1
    ends = np.cumsum(counts)
    got: list[tuple] = []
    low = np.uint64((1 << 20) - 1)
    for a in range(0, max(n, 0), SEGMENT):
        b = min(a + SEGMENT, n)
        h = gram_hashes(sym[a:b + kind.length - 1], kind)
        least, size = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
        while 2 * size <= width:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        if size < width:
            least = np.minimum(least[:len(least) - (width - size)], least[width - size:])
        anchor = (least & low).astype(np.int64)
        doc = np.searchsorted(ends, np.arange(a, b), side="right") if len(ends) > 1 else np.zeros(b - a, np.int64)
        inside = np.arange(a, b) + kind.length <= ends[doc]
        change = np.ones(b - a + 1, bool)
        change[1:-1] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
        edge = np.flatnonzero(change)
        first, last = edge[:-1], edge[1:] - 1
        keep = inside[first]
        first, last = first[keep], last[keep]
        got.append((first + a, last + a, anchor[first] + a, h[anchor[first]], doc[first]))
    if not got:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, np.zeros(0, np.uint64), none)
    return Runs(*(np.concatenate(x) for x in zip(*got)))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def distinct_keys(r: Runs, order: np.ndarray, kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct anchor hashes, and whether each one is in two documents (words: at two places) of the chunk."""
    keys, where = np.unique(r.key, return_inverse=True)
    if kind.words:
        return keys, np.bincount(where, minlength=len(keys)) > 1
    lo, hi = np.full(len(keys), NO_ID), np.full(len(keys), -2**63)
    np.minimum.at(lo, where, order[r.doc])
    np.maximum.at(hi, where, order[r.doc])
    return keys, lo < hi


def marks(sym: np.ndarray, first: np.ndarray, size: np.ndarray, key: np.ndarray, kind: Kind) -> np.ndarray:
    """Hashes of anchor and whole slice, to hold equal slices of the chunk once."""
    step = 1 if kind.words else 8
    each = sym if kind.words or not len(size) else np.ndarray((len(sym) - 7,), "<u8", np.ascontiguousarray(sym), strides=(1,))
    mark = key ^ size.astype(np.uint64)
    for o in range(0, int(size.max()) if len(size) else 0, step):
        part = each[first + np.minimum(o, size - step)]
        mark = np.where(o < size, mix(mark * np.uint64(0x9E3779B97F4A7C15) + part), mark)
    return mark


def variants(sym: np.ndarray, r: Runs, keys: np.ndarray, kind: Kind) -> np.ndarray:
    """How many different slices each of the sorted distinct ``keys`` has in the chunk."""
    where = np.searchsorted(keys, r.key)
    out = np.bincount(where, minlength=len(keys))
    rows = np.flatnonzero(out[where] > 1)
    _, first = np.unique(marks(sym, r.first[rows], (r.last - r.first)[rows] + kind.length, r.key[rows], kind), return_index=True)
    several = np.bincount(where[rows][first], minlength=len(keys))
    return np.where(out > 1, several, out)


def order_of(chunk: Chunk) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in chunk.ids], np.int64)


def repeated_anchors(table: DataFrame, kind: Kind, most: int = MANY) -> tuple[DataFrame, int, bool]:
    """``chunk, masks``: for each bucket one bit for each of the chunk's keys there (a written table), and one more if any
    has more than ``most`` slices; the buckets; and whether any key has."""
    total = table.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(16, -(-total // BUCKET))
    schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("many", pa.binary()),
                        ("several", pa.binary())])

    def several(n: np.ndarray) -> bytes:
        at = np.flatnonzero(n > 1)
        return np.concatenate([at, n[at]]).astype("<u4").tobytes()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, data in zip(batch.column("chunk").to_pylist(), batch.column("data")):
                chunk = Chunk.unpacked(data.as_py())
                sym, counts = symbols(chunk, kind)
                r = runs(sym, counts, kind)
                keys, many = distinct_keys(r, order_of(chunk), kind)
                n = variants(sym, r, keys, kind)
                bucket = bucket_of(keys, buckets)
                cut = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(keys)] if len(keys) else [0]  # the buckets that its keys touch
                rows = [(int(bucket[x]), c, keys[x:y].tobytes(), np.packbits(many[x:y]).tobytes(), several(n[x:y])) for x, y in zip(cut, cut[1:])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.reset_index(drop=True)
        parts = [np.frombuffer(k, np.uint64) for k in rows["keys"]]
        sizes = [len(p) for p in parts]
        many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(rows["many"], sizes)]).astype(bool)
        keys = np.concatenate(parts)
        order = np.argsort(keys, kind="stable")
        s = keys[order]
        same = s[1:] == s[:-1]
        twice = np.zeros(len(s), bool)
        twice[1:] |= same
        twice[:-1] |= same
        seen = many.copy()
        seen[order] |= twice
        number, at = np.ones(len(keys), np.int64), 0
        for more, n in zip(rows["several"], sizes):
            place, count = np.frombuffer(more, "<u4").reshape(2, -1)
            number[at + place.astype(np.int64)] = count
            at += n
        head = np.flatnonzero(np.r_[True, ~same])
        hot = np.empty(len(keys), bool)
        hot[order] = np.repeat(np.add.reduceat(number[order], head) > most, np.diff(np.r_[head, len(s)]))
        hot &= seen
        out, at = [], 0
        for b, c, n in zip(rows["bucket"], rows["chunk"], sizes):
            if seen[at:at + n].any():
                out.append((c, b, np.packbits(seen[at:at + n]).tobytes(), np.packbits(hot[at:at + n]).tobytes() if hot[at:at + n].any() else None))
            at += n
        del parts, many, keys, order, s, same, twice, seen, number, hot
        release()
        return pd.DataFrame(out, columns=["chunk", "bucket", "mask", "hot"])

    sent = map_batches(table.select("chunk", "data"), send, "bucket long, chunk long, keys binary, many binary, several binary")
    masks = written(sent.groupBy("bucket").applyInPandas(meet, "chunk long, bucket long, mask binary, hot binary"), "masks")
    by_chunk = masks.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "mask", "hot")).alias("masks"))
    return (F.broadcast(by_chunk) if small(masks, "mask") else by_chunk), buckets, not masks.where("hot IS NOT NULL").isEmpty()


def repeated_runs(chunk: Chunk, masks: list[dict], buckets: int, kind: Kind, hot: bool = False) -> tuple[np.ndarray, Runs]:
    """The chunk's symbols and its runs at repeated anchors: those with more slices than a task may hold, or all others."""
    sym, counts = symbols(chunk, kind)
    r = runs(sym, counts, kind)
    keys, where = np.unique(r.key, return_inverse=True)
    touched = np.array([m["bucket"] for m in masks], np.int64)
    bucket, on = bucket_of(keys, buckets), np.zeros(len(keys), bool)
    for m, x, y in zip(masks, np.searchsorted(bucket, touched, "left"), np.searchsorted(bucket, touched, "right")):
        many = np.unpackbits(np.frombuffer(m["hot"], np.uint8), count=y - x).astype(bool) if m["hot"] else np.zeros(y - x, bool)
        on[x:y] = many if hot else np.unpackbits(np.frombuffer(m["mask"], np.uint8), count=y - x).astype(bool) & ~many
    keep = on[where]
    return sym, Runs(*(x[keep] for x in (r.first, r.last, r.anchor, r.key, r.doc)))


SLICE = "lead long, key long, chunk long, low long, high long, places binary, slice binary"
SLICES = pa.schema([("lead", pa.int64()), ("key", pa.int64()), ("chunk", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
                    ("places", pa.binary()), ("slice", pa.binary())])


def slices(table: DataFrame, masks: DataFrame, buckets: int, kind: Kind) -> DataFrame:
    """Text of the runs at repeated anchors, equal ones of a chunk once: ``lead`` (the first bytes from the anchor
    on, in text order; words: the key), least and largest document, and the places (starts) of the first window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, data, m in zip(batch.column("chunk").to_pylist(), batch.column("data"), batch.column("masks").to_pylist()):
                chunk = Chunk.unpacked(data.as_py())
                _, r = repeated_runs(chunk, m, buckets, kind)
                order, found = order_of(chunk), {}
                flat = [w for t in chunk.texts for w in t.split()] if kind.words else b"".join(chunk.texts)
                low, high = r.first.tolist(), (r.last + kind.length).tolist()
                for k, (a, b, key) in enumerate(zip(low, high, r.key.tolist())):
                    text = b" ".join(flat[a:b]) if kind.words else flat[a:b]
                    found.setdefault((key, text), []).append(k)
                rows = []
                for (key, text), at in found.items():
                    d, x = order[r.doc[at]], int(r.anchor[at[0]])
                    key = key - 2**64 if key >= 2**63 else key
                    lead = key if kind.words else int.from_bytes(flat[x:x + 8], "big") - 2**63
                    rows.append((lead, key, c, int(d.min()), int(d.max()), r.first[at].astype("<i8").tobytes(), text))
                for lo in range(0, len(rows), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows[lo:lo + 20_000]), SLICES)], schema=SLICES)

    return map_batches(table.select("chunk", "data").join(masks, "chunk"), run, SLICE)


def window_answers(table: DataFrame, masks: DataFrame, buckets: int, kind: Kind) -> DataFrame:
    """``chunk, answer`` for the anchors with more slices than a task may hold: each chunk sends its different windows
    there with their least and largest document and their places, and equal strings meet in an aggregate of Spark."""
    schema = pa.schema([("chunk", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("places", pa.binary()), ("window", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, data, m in zip(batch.column("chunk").to_pylist(), batch.column("data"), batch.column("masks").to_pylist()):
                if not any(x["hot"] for x in m):
                    continue
                chunk, found = Chunk.unpacked(data.as_py()), {}
                _, r = repeated_runs(chunk, m, buckets, kind, hot=True)
                flat = [w for t in chunk.texts for w in t.split()] if kind.words else b"".join(chunk.texts)
                n = r.last - r.first + 1
                start = np.repeat(r.first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                doc = order_of(chunk)[np.repeat(r.doc, n)]
                strings = (b" ".join(flat[a:a + kind.length]) if kind.words else flat[a:a + kind.length] for a in start.tolist())
                where = np.fromiter((found.setdefault(w, len(found)) for w in strings), np.int64, len(start))
                low, high = np.full(len(found), NO_ID), np.full(len(found), -2**63)
                np.minimum.at(low, where, doc)
                np.maximum.at(high, where, doc)
                places = start[np.argsort(where, kind="stable")].astype("<i8")
                ends, windows = np.cumsum(np.bincount(where, minlength=len(found))), list(found)
                for lo in range(0, len(windows), 20_000):
                    hi = min(lo + 20_000, len(windows))
                    at = [places[x:y].tobytes() for x, y in zip(np.r_[0, ends][lo:hi], ends[lo:hi])]
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(([c] * (hi - lo), low[lo:hi], high[lo:hi], at, windows[lo:hi]), schema)], schema=schema)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [np.frombuffer(p, "<i8") for p in batch.column("places").to_pylist()]
            if at:
                n, first = [len(p) for p in at], np.concatenate(at)
                c, least = (np.repeat(batch.column(k).to_numpy(), n) for k in ("chunk", "least"))
                yield from answer_rows(pd.DataFrame({"chunk": c, "first": first, "last": first, "least": least}))

    windows = written(map_batches(table.select("chunk", "data").join(masks, "chunk"), send, "chunk long, low long, high long, places binary, window binary"), "windows")
    if kind.words:
        again = windows.groupBy("window").agg(F.sum(F.octet_length("places")).alias("n")).where("n > 8").select("window", F.lit(0).cast("long").alias("least"))
        found = windows.join(again, "window")
    else:
        again = windows.groupBy("window").agg(F.min("low").alias("least"), F.max("high").alias("last")).where("least < last").select("window", "least")
        found = windows.join(again, "window").where("high > least")
    found = found.select("chunk", "places", "least").repartition("chunk").sortWithinPartitions("chunk")
    return map_batches(found, answer, "chunk long, answer binary")


ANSWER = np.dtype([("first", "<i8"), ("last", "<i8"), ("least", "<i8")])


def answer_rows(found: pd.DataFrame) -> Iterator[pa.RecordBatch]:
    """One binary row a chunk from ``chunk, first, last, least`` intervals of window starts."""
    schema = pa.schema([("chunk", pa.int64()), ("answer", pa.binary())])
    if len(found):
        c, first, last, least = (found[k].to_numpy(np.int64) for k in ("chunk", "first", "last", "least"))
        order = np.argsort(c, kind="stable")
        data = np.empty(len(c), ANSWER)
        data["first"], data["last"], data["least"] = first[order], last[order], least[order]
        c = c[order]
        cut = np.flatnonzero(np.r_[True, c[1:] != c[:-1], True])
        press = zstandard.ZstdCompressor(level=1).compress
        yield pa.RecordBatch.from_arrays([pa.array(c[cut[:-1]]), pa.array([press(data[x:y].tobytes()) for x, y in zip(cut, cut[1:])], pa.binary())], schema=schema)


def answered(table: DataFrame, answers: DataFrame, apply: Callable[[Chunk, np.ndarray], list[tuple]], names: str, schema: pa.Schema) -> DataFrame:
    """``apply`` on every chunk with all its answers: rows for its documents."""
    gathered = answers.groupBy("chunk").agg(F.collect_list("answer").alias("answers"))
    gathered = F.broadcast(gathered) if small(answers, "answer") else gathered

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, parts in zip(batch.column("data"), batch.column("answers").to_pylist()):
                rows = apply(Chunk.unpacked(data.as_py()), np.frombuffer(b"".join(map(zstandard.ZstdDecompressor().decompress, parts or [])), ANSWER))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    return map_batches(table.select("chunk", "data").join(gathered, "chunk", "left"), run, names)


def turns(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pd.DataFrame]:
    """The rows of a partition that is sorted by key, whole keys at a time, about ``most`` rows a turn."""
    held, n = [], 0
    for batch in batches:
        rows = batch.to_pandas()
        if n >= most:
            new = np.flatnonzero(rows["key"].to_numpy() != held[-1]["key"].iloc[-1])
            if len(new):
                yield pd.concat([*held, rows.iloc[:new[0]]], ignore_index=True)
                held, n, rows = [], 0, rows.iloc[new[0]:]
        if len(rows):
            held.append(rows)
            n += len(rows)
    if held:
        yield pd.concat(held, ignore_index=True)
