"""Token codes, packing, WARC archives, URL filter, pipeline: round trips and brute force."""

import base64
import hashlib
import random
import sys
import tempfile
import time
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillsight.llm import packing, token_codes, tokens, url_filter, warc
from tillsight.llm.common import qualified, written

from . import brute

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("special_text", [False, True])
@pytest.mark.parametrize("path,units", [(WORDS, "words"), (BYTES, "blanks")])
def test_units_give_the_tokenizers_ids(path, units, special_text):
    rng = random.Random(4)
    letters = list("abcXYZéñßΣςσİı0129.,'!?$-_ \n\t\r\x0b\x0c\x1c\x85\xa0\u2003\u3000\u0301\u200b中😀“”’") + ["'s", "  ", "<|endoftext|>", "<|startoftext|>", "<|", "Ⅳ", "a" * 70]
    t, e = Tokenizer.from_file(path), tokens.Encoder(path, units, special_text)
    t.encode_special_tokens = special_text
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(5000)]
    texts += ["".join(rng.choice("abeiostz Éßüàÿ.,%") for _ in range(rng.randrange(60))) for _ in range(5000)]
    texts += [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' where text is not null").fetchall()]
    for x, r in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(e.encode(x), "<u4").tolist() == r.ids, x


def test_encoder_cache_turns_over(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 50)
    e = tokens.Encoder(BYTES, "blanks")
    for k in range(60):
        x = " ".join(f"w{j}" for j in range(k, k + 20))
        assert np.frombuffer(e.encode(x), "<u4").tolist() == ids_of(BYTES, x)
    assert len(e.young) <= 50


class Counted(dict):
    asked = 0

    def get(self, *key):
        self.asked += 1
        return super().get(*key)


@pytest.mark.parametrize("path,units", [(WORDS, "words"), (BYTES, "blanks")])
def test_a_column_of_texts_asks_for_each_unit_once(path, units):
    # F1 F2: the cache was asked for every word of every text, and each new word was a call of the library
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdeéü") for _ in range(8)) for _ in range(200)]
    texts = [None, "", *(" ".join(rng.choice(words) for _ in range(500)) for _ in range(40))]
    e, calls = tokens.Encoder(path, units), []
    e.young, encode = Counted(), e.pieces.encode_batch_fast
    e.pieces = type("Library", (), {"encode_batch_fast": lambda self, *a, **k: calls.append(a) or encode(*a, **k)})()
    for x, ids in zip(texts, e.encode_all(pa.array(texts))):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(path, x)
    assert e.young.asked <= 4 * len(words) and len(calls) == 1


@pytest.mark.parametrize("path,units", [(WORDS, "words"), (BYTES, "blanks")])
def test_units_end_with_their_text(path, units):
    rng = random.Random(7)
    some = list("abÉß×÷'1.,!-_ \n\t\xa0\u2003\u3000\u0301中") + ["", "  ", " ", ". ", "<|endoftext|>"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(12))) if rng.randrange(20) else None for _ in range(8000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]).slice(5)
    t, e = Tokenizer.from_file(path), tokens.Encoder(path, units)
    slices = list(tokens.portions(batch, 20_000))
    assert 3 < len(slices) < 20 and sum(x.num_rows for x in slices) == batch.num_rows
    got = [np.frombuffer(x, "<u4").tolist() for part in slices for x in e.encode_all(part.column("text"))]
    assert got == [x.ids for x in t.encode_batch([x or "" for x in texts[5:]], add_special_tokens=False)]


def test_shard_random_access():
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.integers(0, 70_000, n).astype(np.uint32)
        ids[::7] = 3
        if n > 5:
            ids[5] = 2**32 - 1
        s = token_codes.Shard(token_codes.encode_shard([1, None, 3], [n // 3, 0, n - n // 3], ids))
        assert s.run(0, n).tolist() == ids.tolist() and [s.token(i) for i in range(n)] == ids.tolist()
        assert s.doc_ids == [1, None, 3] and s.document(2).tolist() == ids[n // 3:].tolist()
    with pytest.raises(ValueError):
        token_codes.Shard(b"x" * 40)


def test_token_codes(spark, docs, rows, no_docs):
    folder = tempfile.mkdtemp()
    manifest = token_codes.write_shards(docs, folder, WORDS, shard=500)
    got = [tuple(r) for r in token_codes.read_shards(spark, folder, manifest).collect()]
    want = defaultdict(list)
    for i, t in rows:
        ids = np.array([*ids_of(WORDS, t), 2], "<u4")
        want[i].append((len(ids), zlib.crc32(ids.tobytes())))
    at = 0
    for i, start, n, crc in sorted(got, key=lambda r: r[1]):
        assert start == at and (n, crc) in want[i]
        want[i].remove((n, crc))
        at += n
    assert not any(want.values())
    order = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert token_codes.read_shards(spark, folder, token_codes.write_shards(no_docs, tempfile.mkdtemp(), WORDS)).count() == 0


def test_shards_are_read_outside_the_jvm(spark, docs, monkeypatch):
    # every file was a binary row, copied several times in the executor's JVM
    monkeypatch.setattr(token_codes, "READ", 2, raising=False)
    folder = tempfile.mkdtemp()
    manifest = token_codes.write_shards(docs, folder, WORDS, shard=500)
    got = token_codes.read_shards(spark, folder, manifest)
    assert "binary" not in got._jdf.queryExecution().toString().lower()
    assert got.rdd.getNumPartitions() == -(-manifest.count() // 2) > 1


@pytest.mark.parametrize("path,units", [(WORDS, "words"), (BYTES, "blanks")])
def test_encoder_cache_stays_small(path, units):
    # a worker's cached units grew to 76 (words) and 106 MB (blanks) here, beside the executor's heap
    rng, e = random.Random(9), tokens.Encoder(path, units)
    for _ in range(8):
        words = ["".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(100_000)]
        texts = [" ".join(words[k:k + 100]) for k in range(0, len(words), 100)]
        ids = e.encode_all(pa.array(texts))
        assert np.frombuffer(ids[-1], "<u4").tolist() == ids_of(path, texts[-1])
        held = sum(sys.getsizeof(x) + sum(sys.getsizeof(u) + sys.getsizeof(v) for u, v in x.items()) for x in (e.young, e.old))
        assert held < 65_000_000


def test_patterns_hold_every_piece():
    rng = random.Random(8)
    for n in (1, 3, 40, 900):
        counts = defaultdict(int)
        for _ in range(n):
            counts[rng.randrange(1, 65)] += rng.choice([1, 1, 5])
        found, left = packing.patterns(counts, 64)
        assert all(sum(c * k for c, k in held.items()) <= 64 for _, held in found)
        rows, n_sequences = packing.slots(found, left, 64)
        assert all(sum(r[2] - r[1] for r in rows if r[0] == c) == k for c, k in counts.items())
        used = sum(c * k for c, k in counts.items())
        assert n_sequences >= used / 64 and (n < 900 or n_sequences <= 1.02 * used / 64 + 1)
    assert packing.patterns({}, 64) == ([], {})


def test_packing(docs, rows, no_docs):
    pieces = packing.pack(docs, BYTES, length=128, grain=4).cache()
    want = sorted([*ids_of(BYTES, t), 1] for _, t in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces.collect():
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] > 0
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"], r["ids"]))
        if r["doc_id"] is not None and r["doc_id"] != 51:
            by_doc[r["doc_id"]].append((r["start"], r["doc_tokens"], r["ids"]))
    texts = {i: t for i, t in rows if i is not None and i != 51}
    assert by_doc.keys() == texts.keys()
    for i, t in texts.items():
        ids = [*ids_of(BYTES, t), 1]
        assert np.frombuffer(b"".join(x[2] for x in sorted(by_doc[i])), "<u4").tolist() == ids and {x[1] for x in by_doc[i]} == {len(ids)}
    total = 0
    for s in by_sequence.values():
        at = 0
        for offset, n, _ in sorted(s):
            assert offset == at
            at += n
        assert at <= 128
        total += at
    assert total == sum(map(len, want)) and len(by_sequence) <= 1.03 * total / 128 + 2
    for r in packing.sequences(pieces, 128, pad_id=9).collect():
        held = b"".join(x[2] for x in sorted(by_sequence[r["sequence_id"]]))
        assert bytes(r["ids"]) == held + (9).to_bytes(4, "little") * (r["padded"] - r["used"])
        assert r["padded"] == (r["used"] if r["used"] & (r["used"] - 1) == 0 else 128)
    assert packing.pack(no_docs, BYTES).count() == 0


PAGES = [(3, "http://A.example.org/x", "<p>same</p>"), (1, "http://b.example.org/\r\ny?q", "<p>same</p>"), (2, None, None), (4, "z", ""),
         (5, "http://c.example.net/", "é" * 60_000), (6, "http://d/", "é" * 60_000), (7, "u", "tail"), (None, "n", "tail"), (8, "r", "twin"), (8, "r", "twin")]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, sha string, rid string").repartition(2)
    folder = tempfile.mkdtemp()
    files = warc.write_archives(pages, folder)
    got = warc.read_archives(spark, folder, files)
    payload = {r["page_id"]: bytes(r["payload"]) for r in got.where("payload is not null and page_id is not null").collect()}
    assert payload[5] == ("é" * 60_000).encode() and payload[2] == b"" == warc.unchunked(warc.chunked(b""))
    rows = sorted(map(tuple, warc.digests(got).collect()), key=lambda r: (r[0] is None, r[0], r[3]))
    first = {}
    for i, _, h in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        first.setdefault(h or "", i)
    twins = 0
    for i, n, digest, kind, refers, status in rows:
        body = {p[0]: p[2] or "" for p in PAGES}[i].encode()
        assert (n, digest, status) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "ok")
        response = first[body.decode()] == i
        if i == 8:
            twins += kind == "response"
        else:
            assert (kind, refers) == (("response", None) if response else ("revisit", first[body.decode()]))
    assert twins == 1 and len(rows) == len(PAGES)
    assert warc.read_archives(spark, folder, warc.write_archives(pages.limit(0), tempfile.mkdtemp())).count() == 0


def test_broken_segments_are_told(spark):
    columns = "record_id string, type string, page_id long, url string, digest string, refers_to_id string, origin string, number int, total long, block binary"
    rows = [("a", "response", 1, None, None, None, None, 1, None, b"12"), ("b", "continuation", None, None, None, None, "a", 2, 4, b"34"),
            ("c", "response", 2, None, None, None, None, 1, None, b"12"), ("d", "continuation", None, None, None, None, "c", 3, 4, b"34"),
            ("e", "response", 3, None, None, None, None, 1, None, b"12"), ("f", "continuation", None, None, None, None, "e", 2, 9, b"34"),
            ("g", "continuation", None, None, None, None, "lost", 2, 4, b"34"), ("h", "response", 4, None, None, None, None, None, None, b"x")]
    got = {r["record_id"]: (r["status"], bytes(r["block"])) for r in warc.reassembled(spark.createDataFrame(rows, columns)).collect()}
    assert got == {"a": ("ok", b"1234"), "c": ("segment missing", b"1234"), "e": ("wrong total length", b"1234"),
                   "lost": ("no first segment", b"34"), "h": ("ok", b"x")}


URLS = [(1, "http://A.Example.NET/en/1?x"), (2, "https://example.com/de/2#y"), (3, "http://x.org/fr/"), (4, "http://x.org"), (5, "nothing"), (6, None),
        (7, "http://net/"), (8, "http://x.net?/en/"), (9, "a://b://c.net/d"), (10, "http://notexample.com/de/"), (11, "http://q.example.org/"), (11, "http://q.example.org/")]


def test_url_rules_and_walk(spark):
    links = {1: ["http://q.example.org/", "//m.example.com/de/"], 2: ["http://q.example.org/a"], 3: ["http://m.example.com/"], 10: ["https://example.com/de/9"],
             11: ["http://notexample.com/"]}
    pages = [(i, u, None if u is None else "".join(f'<a class="k" href="{x}">t</a>' for x in links.get(i, [])) + '<a href="/local">') for i, u in URLS]
    got = url_filter.judge(spark.createDataFrame([(*p, "r") for p in pages], "page_id long, url string, html string, rule string")).collect()
    by = defaultdict(list)
    for r in got:
        by[r["page_id"]].append(r)
    assert [(by[k][0]["host"], by[k][0]["path"], by[k][0]["rule"]) for k in range(1, 10)] == [
        ("a.example.net", "/en/1", "example.net/en/"), ("example.com", "/de/2", "example.com/de/"), ("x.org", "/fr/", "org/fr/"), ("x.org", "", None),
        ("", "", None), ("", "", None), ("net", "/", "net/"), ("x.net", "", None), ("b:", "//c.net/d", None)]
    assert len(got) == len(URLS) and len(by[11]) == 2
    assert [by[k][0]["verdict"] for k in (1, 2, 3, 5, 6, 7)] == ["allow", "block", "allow", "allow", "allow", "block"]
    edges = defaultdict(float)
    for i, u, h in pages:
        src = brute_host(u)
        for x in links.get(i, []):
            dst = brute_host(x if ":" in x else "http:" + x)
            if src and dst and src != dst:
                edges[src, dst] += 1
    ruled = defaultdict(lambda: defaultdict(int))
    for k, r in ((r["page_id"], r) for r in got):
        if r["rule"]:
            ruled[r["verdict"]][r["host"]] += 1
    trust = walk(edges, ruled["allow"])
    distrust = walk({(b, a): n for (a, b), n in edges.items()}, ruled["block"])
    for r in got:
        if r["host"]:
            assert abs((r["trust"] or 0) - trust.get(r["host"], 0)) < 1e-9 and abs((r["distrust"] or 0) - distrust.get(r["host"], 0)) < 1e-9
            if not r["rule"]:
                assert r["verdict"] == ("block" if distrust.get(r["host"], 0) > trust.get(r["host"], 0) else "allow")
    assert by[10][0]["verdict"] == "block"
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_walk_runs_until_it_has_converged(spark):
    chain = [f"h{k}.example" for k in range(15)] + ["x.net"]
    links = {(a, b): 1 for a, b in zip(chain, chain[1:])} | {("h3.example", "h5.example"): 2, ("a.example", "b.example"): 1, ("b.example", "a.example"): 1,
                                                          ("c.example", "a.example"): 50, ("a.example", "x.net"): 1}
    pages = [(k, f"http://{a}/", f'<a href="http://{b}/">' * n) for k, ((a, b), n) in enumerate(links.items())] + [(99, "http://x.net/", "")]
    got = {r["host"]: r for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    back = {(b, a): n for (a, b), n in links.items()}
    rank, out = {"x.net": 1.0}, defaultdict(int)
    for (a, _), n in back.items():
        out[a] += n
    for _ in range(400):
        new = defaultdict(float)
        for (a, b), n in back.items():
            new[b] += 0.85 * rank.get(a, 0.0) * n / out[a]
        new["x.net"] += 1 - sum(new.values())
        rank = new
    assert all(abs(got[h]["distrust"] - rank[h]) < 1e-10 and rank[h] > 0 for h in [*chain, "a.example", "b.example", "c.example"])
    assert {r["verdict"] for r in got.values()} == {"block"}


def test_a_chain_of_thousands_of_hosts_ends(spark):
    edges = spark.createDataFrame([(f"h{k}", f"h{k + 1}", 1) for k in range(3000)], "src string, dst string, n long")
    got = {r["host"]: r["rank"] for r in url_filter.propagate(edges, spark.createDataFrame([("h0", 1.0)], "host string, weight double"), "t").collect()}
    assert all(abs(got[f"h{k}"] / got["h0"] - 0.85**k) < 1e-9 for k in range(170)) and len(got) < 400


def test_hostile_html_is_read_in_one_pass(spark):
    html = "<a " * 350_000 + "<a href=http://x.net/> <a " + "href " * 100_000 + "<a href  =  'https://y.net/p'>" + "<a href" + " " * 200_000
    pages = spark.createDataFrame([(1, "http://s.org/", html)], "page_id long, url string, html string")
    began = time.time()
    assert sorted((r["src"], r["dst"], r["n"]) for r in url_filter.host_edges(pages).collect()) == [("s.org", "x.net", 1), ("s.org", "y.net", 1)]
    assert time.time() - began < 30


def test_folders_are_resolved_as_spark_does(spark):
    assert pafs.FileSystem.from_uri(qualified(spark, "/tmp/a b"))[1] == "/tmp/a b"
    assert qualified(spark, "file:///tmp/x") == qualified(spark, "/tmp/x") == "file:///tmp/x"


def test_a_large_record_is_reassembled(spark):
    n, piece = 400, bytes(range(256)) * 800
    rows = spark.range(n).select(
        F.concat(F.lit("r"), F.col("id")).alias("record_id"), F.when(F.col("id") == 0, "response").otherwise("continuation").alias("type"), F.lit(1).cast("long").alias("page_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("url", "digest", "refers_to_id")], F.when(F.col("id") > 0, "r0").alias("origin"),
        (F.col("id") + 1).cast("int").alias("number"), F.when(F.col("id") == n - 1, n * len(piece)).cast("long").alias("total"), F.lit(piece).alias("block"))
    began = time.time()
    got = warc.reassembled(rows).select("record_id", "status", F.sha2("block", 256).alias("sha")).collect()
    assert [tuple(r) for r in got] == [("r0", "ok", hashlib.sha256(piece * n).hexdigest())]     # 82 MB
    assert time.time() - began < 60


def brute_host(url):
    return url.split("://", 1)[1].split("/")[0].split("?")[0].split("#")[0].lower() if url and "://" in url else ""


def walk(edges, seeds):
    total = sum(seeds.values())
    start = {h: n / total for h, n in seeds.items()} if total else {}
    out = defaultdict(float)
    for (a, _), n in edges.items():
        out[a] += n
    rank = dict(start)
    for _ in range(1000 if edges else 0):
        new = defaultdict(float)
        for (a, b), n in edges.items():
            new[b] += 0.85 * rank.get(a, 0) * n / out[a]
        back = 1 - sum(new.values())
        for h, w in start.items():
            new[h] += w * back
        rank = new
    return rank


def test_pipeline_stages_on_odd_rows(spark, docs, no_docs):
    import corpus_pipeline
    odd = docs.withColumn("_llm_id", F.lit(1)).withColumn("_row", F.lit("r")).withColumn("_id", F.lit(2))
    for table in (odd, odd.where("doc_id IS NULL"), no_docs.withColumn("_row", F.lit("r"))):
        here = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns, here = here.columns, written(stage(spark, here, "/root/testdata/sf0.001"), "odd")
            assert here.columns == columns
        rows = here.select("doc_id", "text").collect()
        assert all(len((r["text"] or "").split()) >= 50 for r in rows)
        assert sum(r["doc_id"] is None for r in rows) == (0 if table is not odd and table.isEmpty() else 2)     # rows without an id stay, each by its own text
        pieces = corpus_pipeline.STAGES[-1][1](spark, here, "/root/testdata/sf0.001").collect()
        assert sum(r["length"] for r in pieces) == sum(len(ids_of(BYTES, r["text"])) + 1 for r in rows)


def test_pipeline_stages(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, sf).cache()
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and after.keys() <= before.keys()
        if name.startswith("quality"):
            failed = {i for i, t in before.items() if (s := brute.quality_stats(t))[0] < 50 or 100 * s[4] > 50 * s[0]}
            assert not failed & after.keys()
        if name.startswith("n-gram"):
            assert after.keys() == {i for i, (c, _, _) in brute.near(list(before.items())).items() if i == c}
        if name.startswith("benchmark"):
            items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
            assert after.keys() == before.keys() - {c[0] for c in brute.contained(before.items(), items)}
        if name == "PII":
            assert after.keys() == before.keys() and not any(brute.base_spans(t) for t in after.values())
        kept.append(len(after))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert sum(r["length"] for r in pieces) == sum(len(ids_of(BYTES, t)) + 1 for t in after.values())
    assert {r["doc_id"] for r in pieces} == after.keys()
