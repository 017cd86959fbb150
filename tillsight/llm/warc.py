"""WARC archives with revisits, segmented records and chunked transfer framing: written and read back.

Writing: every page becomes a record with an HTTP block whose body is framed in chunks. Of records with equal
payloads the one with the least page id is a ``response``, the others are ``revisit`` records that refer to
it. A block longer than ``SEGMENT`` goes on in ``continuation`` records. Records are compressed one by one;
tasks write files of about ``FILE`` bytes with names unique to the attempt to a shared folder, and the written
manifest of finished tasks says which files count.

Reading: continuation records are grouped by their origin id and ordered by segment number; the numbers must
run from 1 and the total length must fit, then the chunked framing is decoded. A broken record keeps its row
with ``status`` naming the fault and null payload. Revisits take payload length and digest from their response.

Edge cases: null html is an empty payload; null page ids come after all others when the response is chosen;
of repeated rows of one page one is the response; null urls have no target header; extra columns are ignored;
an empty table has no files. A page of any length is cut into segments and joined again in one go; one page at a time
must fit into a task's memory.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, qualified, sized, written

SEGMENT, CHUNK, FILE = 32_768, 8_192, 8_000_000
DATE = "2024-01-01T00:00:00Z"


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(body[i:i + size]), body[i:i + size]) for i in range(0, len(body), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = end + 2
        if data[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        out.append(data[at:at + size])
        at += size + 2


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(rid: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(rid))}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def page_records(page_id, url, payload: bytes, rid: int, first_rid: int | None, segment: int = SEGMENT) -> list[bytes]:
    """A page's record and its continuations; ``first_rid`` is the row of the response it repeats, if any."""
    common = [("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    common += [("X-Page-Id", str(page_id))] if page_id is not None else []
    # a header value has no line ends: such urls are kept percent-encoded
    common += [("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A"))] if url is not None else []
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    kind = [("Content-Type", "application/http; msgtype=response")]
    if first_rid is not None:
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(rid)), *common, *kind, ("WARC-Refers-To", record_id(first_rid)),
                         ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], http)]
    block = http + chunked(payload)
    cuts = [block[i:i + segment] for i in range(0, len(block), segment)]
    numbered = [("WARC-Segment-Number", "1")] if len(cuts) > 1 else []
    out = [_record([("WARC-Type", "response"), ("WARC-Record-ID", record_id(rid)), *common, *kind, *numbered], cuts[0])]
    for k, cut in enumerate(cuts[1:], 2):
        total = [("WARC-Segment-Total-Length", str(len(block)))] if k == len(cuts) else []
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                            ("WARC-Segment-Origin-ID", record_id(rid)), ("WARC-Segment-Number", str(k)), *total], cut))
    return out


def members(data: bytes, step: int = 1 << 14) -> Iterator[bytes]:
    """The compressed records of an archive, fed in steps so that the rest is not copied for each record."""
    at = 0
    while at < len(data):
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if at >= len(data):
                raise ValueError("archive ends within a record")
            piece = data[at:at + step]
            out.append(z.decompress(piece))
            at += len(piece)
        at -= len(z.unused_data)
        yield b"".join(out)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the files; the manifest (a written table): ``file, n_records``."""
    uri = qualified(pages.sparkSession, folder)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = written(rows.select("*", F.concat_ws(":", F.octet_length("html"), F.sha2(F.encode("html", "utf-8"), 256)).alias("sha"), F.monotonically_increasing_id().alias("rid")), "pages")
    same = rows.groupBy("sha").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "rid")).alias("m"), F.count("*").alias("n"))
    same = written(same.where("n > 1").select(F.col("sha").alias("_sha"), F.col("m.rid").alias("first_rid")), "repeats")
    rows = rows.join(sized(same), F.col("sha") == F.col("_sha"), "left").select(
        "page_id", "url", "html", "rid", F.when(F.col("first_rid") != F.col("rid"), F.col("first_rid")).alias("first_rid"))
    schema = pa.schema([("file", pa.string()), ("n_records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(uri)
        held, size = [], 0

        def close():
            name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write(b"".join(held))
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)], pa.int64())], schema=schema)

        for batch in batches:
            ids, rids, firsts = (batch.column(c).to_pylist() for c in ("page_id", "rid", "first_rid"))
            for k, (url, html) in enumerate(zip(batch.column("url"), batch.column("html"))):
                new = page_records(ids[k], url.as_py(), html.as_py().encode(), rids[k], firsts[k])
                held += new
                size += sum(map(len, new))
                if size >= FILE:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return written(map_batches(rows, run, "file string, n_records long"), "archives")


RECORDS = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
                     ("refers_to_id", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])


def records(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """The records of the manifest's files as they lie there (a written table)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                rows, size = [], 0
                for raw in members(data.as_py()):
                    head, _, rest = raw.partition(b"\r\n\r\n")
                    h = {k.lower(): v for k, v in (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])}
                    number = lambda k: int(h[k]) if k in h else None
                    block = rest[:int(h["content-length"])]
                    rows.append((h["warc-record-id"], h["warc-type"], number("x-page-id"), h.get("warc-target-uri"),
                                 h.get("warc-payload-digest", "").removeprefix("sha1:"), h.get("warc-refers-to"),
                                 h.get("warc-segment-origin-id"), number("warc-segment-number"), number("warc-segment-total-length"), block))
                    size += len(block)
                    if size > 4_000_000:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    names = manifest.select("file")
    files = spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content")
    return written(map_batches(files.join(sized(names), "file").select("content"), run,
                               "record_id string, type string, page_id long, url string, digest string, refers_to_id string, origin string, "
                               "number int, total long, block binary"), "records")


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORDS)], schema=RECORDS)


def _joined(parts: DataFrame) -> DataFrame:
    """``blocks`` joined to ``block`` in one go, whatever their number."""
    schema = T.StructType([f for f in parts.schema.fields if f.name != "blocks"] + [T.StructField("block", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):  # a record may be as large as a task can hold: one at a time
                row = batch.slice(k, 1)
                block = b"".join(x.as_py() or b"" for x in row.column("blocks")[0])
                rest = [n for n in row.schema.names if n != "blocks"]
                yield pa.RecordBatch.from_arrays([*[row.column(n) for n in rest], pa.array([block], pa.binary())], names=[*rest, "block"])

    return map_batches(parts, run, schema)


def reassembled(found: DataFrame) -> DataFrame:
    """Records with whole blocks and ``status``: segments grouped by origin (a record's own segments only) and ordered."""
    single = found.where("type <> 'continuation' AND number IS NULL").withColumn("status", F.lit("ok"))
    parts = found.where("type = 'continuation' OR number IS NOT NULL").withColumn("_key", F.coalesce("origin", "record_id"))
    whole = parts.groupBy("_key").agg(
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("s"), F.max("total").alias("total"),
        *[F.max(F.when(F.col("type") != "continuation", F.col(c))).alias(c) for c in ("type", "page_id", "url", "digest", "refers_to_id")])
    whole = _joined(whole.withColumn("blocks", F.transform("s", lambda x: x["block"])).withColumn("numbers", F.transform("s", lambda x: x["number"])).drop("s"))
    whole = whole.select(F.col("_key").alias("record_id"), "type", "page_id", "url", "digest", "refers_to_id", "total", "block",
                         (F.col("numbers") == F.sequence(F.lit(1), F.size("numbers"))).alias("_run"))
    status = (F.when(F.col("type").isNull(), "no first segment").when(~F.col("_run"), "segment missing")
              .when(F.col("total").isNull() | (F.col("total") != F.octet_length("block")), "wrong total length").otherwise("ok"))
    cols = ["record_id", "type", "page_id", "url", "digest", "refers_to_id", "block", "status"]
    return single.select(*cols).union(whole.withColumn("status", status).select(*cols))


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``page_id, url, record_type, payload, status, record_id, refers_to_id, digest``: payloads of responses, decoded."""
    schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
                        ("refers_to_id", pa.string()), ("payload", pa.binary()), ("status", pa.string())])
    names = "record_id string, type string, page_id long, url string, digest string, refers_to_id string, payload binary, status string"
    if manifest.isEmpty():
        return spark.createDataFrame([], names)

    def decode(block: bytes, type_: str, digest: str, status: str) -> tuple[bytes | None, str]:
        if status != "ok" or type_ != "response":
            return None, status
        head, _, body = block.partition(b"\r\n\r\n")
        try:
            body = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
        except ValueError:
            return None, "broken chunk framing"
        return (body, "ok") if base32_sha1(body) == digest else (None, "wrong digest")

    def run(batches):
        for batch in batches:
            got = [decode(b.as_py(), *x) for b, *x in zip(batch.column("block"), *(batch.column(c).to_pylist() for c in ("type", "digest", "status")))]
            cols = [batch.column(c) for c in ("record_id", "type", "page_id", "url", "digest", "refers_to_id")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([p for p, _ in got], pa.binary()), pa.array([s for _, s in got])], schema=schema)

    return map_batches(reassembled(records(spark, folder, manifest)), run, names)


def digests(archives: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, status``; a revisit's payload is its response's."""
    small = written(archives.select("record_id", "page_id", "type", "digest", "refers_to_id", "status", F.octet_length("payload").cast("long").alias("n")), "payloads")
    seen = small.where("type = 'response'").select(F.col("record_id").alias("_id"), F.col("page_id").alias("_page"), F.col("n").alias("_n"))
    again = small.where("type = 'revisit'").join(seen, F.col("refers_to_id") == F.col("_id"), "left")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status"]
    rest = small.where("type <> 'revisit' OR type IS NULL")
    return (rest.select("page_id", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                        F.lit(None).cast("long").alias("refers_to"), "status")
            .union(again.select("page_id", F.col("_n"), "digest", "type", F.col("_page"), "status"))).select(*cols)
