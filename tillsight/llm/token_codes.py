"""Token ids in directly addressable codes: chunk levels with continuation bitmaps and rank directories.

An id is cut into chunks of 8 bits. Level 0 has the lowest chunk of every id and a bitmap that tells which ids
go on; level 1 has the next chunk of just those, and so on. The place of an id's next chunk is the rank of its
bit, taken from a directory of counts every 512 bits and a count within one block: any id is read in a
few steps without decoding a block (``Shard.token``), any run by slices (``Shard.run``).

A shard file holds the magic, a header of lengths, the documents' ids and token starts, then the levels. Tasks
write shards of about ``SHARD`` tokens in ascending ``doc_id`` order to the given folder of a shared store (any
that pyarrow's file systems open by URI); a file name is unique to the task's attempt, and only the shards in
the written manifest of finished tasks count, so lost or repeated attempts leave no trace in the result.

Edge cases: null and empty texts are the end id alone; null ids come first and are kept; repeated ids stay
separate documents in the order of their text's hash; extra columns are ignored; an empty table has no shards.
Texts of any length are encoded whole; one document's ids must fit into a task's memory.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_batches, qualified, written
from .tokens import encoder, portions

MAGIC, BLOCK, SHARD = b"DACTOK01", 512, 1_000_000
#: Files that a task reads.
READ = 4


def encode_shard(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """One file: documents (a null id has the flag 0) and their token counts; ids of all of them in order."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        chunk, rest = (rest & 0xFF).astype(np.uint8), rest >> 8
        goes_on = rest > 0
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else np.zeros(0, "<u4")
        levels.append((len(chunk), chunk.tobytes(), bits.tobytes(), ranks.tobytes()))
        if not goes_on.any():
            break
        rest = rest[goes_on]
    out = [MAGIC, struct.pack("<QQB", len(doc_ids), len(ids), len(levels)), struct.pack(f"<{len(levels)}Q", *[x[0] for x in levels]),
           np.array([d is not None for d in doc_ids], np.uint8).tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
           np.concatenate([[0], np.cumsum(counts)]).astype("<u8").tobytes()]
    for _, chunk, bits, ranks in levels:
        out += [chunk, bits, ranks]
    return b"".join(out)


class Shard:
    """Random access to a shard's bytes; nothing is decoded before it is asked for."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token shard")
        n_docs, self.n_tokens, n_levels = struct.unpack_from("<QQB", data, 8)
        at = 25
        lengths = struct.unpack_from(f"<{n_levels}Q", data, at)
        at += 8 * n_levels

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        known = take(np.uint8, n_docs)
        self.doc_ids = [int(d) if k else None for k, d in zip(known, take("<i8", n_docs))]
        self.starts = take("<u8", n_docs + 1).astype(np.int64)
        self.levels = []
        for n in lengths:
            blocks = -(-n // BLOCK)
            self.levels.append((take(np.uint8, n), take(np.uint8, blocks * BLOCK // 8), take("<u4", blocks)))

    @staticmethod
    def rank(level, i: int) -> int:
        """Ones before bit i."""
        _, bits, ranks = level
        if i // BLOCK >= len(ranks):
            return int(ranks[-1]) + int(np.bitwise_count(bits[-(BLOCK // 8):]).sum()) if len(ranks) else 0
        first = i // BLOCK * (BLOCK // 8)
        ones = int(np.bitwise_count(bits[first:i // 8]).sum())
        return int(ranks[i // BLOCK]) + ones + (int(bits[i // 8] & ((1 << i % 8) - 1)).bit_count() if i % 8 else 0)

    def token(self, i: int) -> int:
        out = 0
        for k, level in enumerate(self.levels):
            out |= int(level[0][i]) << 8 * k
            if not level[1][i // 8] >> (i % 8) & 1:
                return out
            i = self.rank(level, i)
        return out

    def run(self, a: int, b: int) -> np.ndarray:
        """Ids a to b-1: a slice of every level, placed by the bits of the level above."""
        out, where = np.zeros(b - a, np.uint32), np.arange(b - a)
        for k, level in enumerate(self.levels):
            if b <= a:
                break
            out[where] |= level[0][a:b].astype(np.uint32) << np.uint32(8 * k)
            bits = np.unpackbits(level[1][a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a].astype(bool)
            where, (a, b) = where[bits], (self.rank(level, a), self.rank(level, b))
        return out

    def document(self, k: int) -> np.ndarray:
        return self.run(int(self.starts[k]), int(self.starts[k + 1]))


def write_shards(docs: DataFrame, folder: str, path: str, units: str = "words", end_id: int = 2, shard: int = SHARD) -> DataFrame:
    """Write the files; the manifest (a written table): ``part, seq, file, n_docs, n_tokens``."""
    uri = qualified(docs.sparkSession, folder)
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, end = encoder(path, units), TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        fs, root = pafs.FileSystem.from_uri(uri)
        ids, docs_in, counts, size, seq = [], [], [], 0, 0

        def close():
            name = f"part-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.dac"
            data = encode_shard(docs_in, counts, np.frombuffer(b"".join(ids), "<u4"))
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{name}") as f:
                f.write(data)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((part, seq, name, len(docs_in), size), schema)], schema=schema)

        for batch in (part for whole in batches for part in portions(whole)):
            for d, got in zip(batch.column("doc_id").to_pylist(), e.encode_all(batch.column("text"))):
                got += end
                ids.append(got)
                docs_in.append(d)
                counts.append(len(got) // 4)
                size += len(got) // 4
                if size >= shard:
                    yield close()
                    ids, docs_in, counts, size, seq = [], [], [], 0, seq + 1
        if docs_in:
            yield close()

    order = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
    order = order.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    return written(map_batches(order, run, "part int, seq int, file string, n_docs long, n_tokens long"), "manifest")


def read_shards(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files. Tasks open the files
    themselves, one after the other, so that no file passes through the JVM (as a row it would be copied there
    several times, in arrays of megabytes)."""
    so_far = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))  # one row a task
    parts = parts.select("part", so_far(Window.orderBy("part")).alias("_base"))
    places = manifest.select("part", "file", so_far(Window.partitionBy("part").orderBy("seq")).alias("_in")).join(parts, "part")
    places = written(places.select(F.col("file"), (F.col("_base") + F.col("_in")).alias("start")), "places")
    uri = qualified(spark, folder)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with fs.open_input_stream(f"{root}/{name}") as f:
                    s = Shard(f.read())
                crc = [zlib.crc32(s.document(k).astype("<u4").tobytes()) for k in range(len(s.doc_ids))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.doc_ids, pa.int64()), pa.array(s.starts[:-1] + start), pa.array(np.diff(s.starts)), pa.array(crc, pa.int64())],
                    schema=schema)

    return map_batches(places.repartition(-(-places.count() // READ) or 1), run, "doc_id long, start long, n_tokens long, ids_crc32 long")
