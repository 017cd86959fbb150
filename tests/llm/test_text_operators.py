"""Quality rules, decontamination, near copies, personal data, exact repeats: edge rows against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillsight.llm import components, decontaminate, ngram_join, phrase_dedup, pii, quality_rules, repeats, suffix_dedup
from tillsight.llm.common import written

from . import brute

SF = "/root/testdata/sf0.001"


def bag(got):
    return sorted(got, key=lambda r: tuple((x is None, x) for x in r))


def test_quality_statistics(docs, rows, no_docs):
    got = quality_rules.judge(docs, []).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    want = []
    for i, t in rows:
        s = brute.quality_stats(t)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        want.append((i, *s, failed, not failed))
    assert bag(map(tuple, got.collect())) == bag(want)
    assert quality_rules.judge(no_docs, []).count() == 0


def test_decision_list_learns_and_reads_back():
    rng = random.Random(1)
    data = []
    for k in range(600):
        row = {f: rng.random() for f in quality_rules.FEATURES}
        row["bad"] = row["symbol_rate"] > 0.7 or (row["upper_rate"] > 0.5 and row["mean_word"] < 0.3)
        data.append({**row, "fold": k % 3})
    rules = quality_rules.cover(data)
    caught = [any(all(c.holds(r) for c in rule) for rule in rules) for r in data]
    assert sum(c == r["bad"] for c, r in zip(caught, data)) > 0.95 * len(data)
    assert quality_rules.cover([]) == [] and quality_rules.cover([{**data[0], "bad": True}]) == []


def test_decision_list_on_labels(spark):
    d, y = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality_rules.learn_rules(d, y)
    got = quality_rules.judge(d, rules).where("not base_failed").join(y, "doc_id").where("quality is not null").groupBy("quality", "kept").count().collect()
    right = sum(r["count"] for r in got if r["kept"] == (r["quality"] == 1))
    assert right >= 0.9 * sum(r["count"] for r in got)
    nulls = spark.createDataFrame([(None, 0, 0), (1, None, 1)], "doc_id long, quality int, toxic int")
    assert quality_rules.learn_rules(d, nulls) == []


def test_containment(spark, docs, rows, no_docs):
    texts = dict((i, t) for i, t in rows if i is not None)
    long = texts[48].split()
    items = [(1, texts[40]), (2, " ".join(long[20_000:20_040])), (3, "four words only here"), (4, None), (5, ""), (None, " ".join(long[5:30])),
             (6, " ".join(long[100:120] + ["zzz"] + long[121:140])), (7, " ".join(long[100:108] + ["zzz"] * 30)), (2, " ".join(long[20_000:20_040]).upper())]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, h long")
    got = {tuple(r)[:4] for r in decontaminate.contained(docs, benchmark).collect()}
    assert got == brute.contained(rows, items)
    assert {(48, 2), (48, None)} <= {g[:2] for g in got}
    assert decontaminate.contained(no_docs, benchmark).count() == 0
    assert decontaminate.contained(docs, benchmark.limit(0)).count() == 0
    bad = {g[0] for g in got}
    left = decontaminate.clean(docs, benchmark)
    assert left.columns == docs.columns
    assert bag((r["doc_id"],) for r in left.collect()) == bag((i,) for i, _ in rows if i not in bad)


def test_sketch_plan_misses_almost_nothing():
    for p, (m, r) in enumerate(decontaminate.sketch_plan()):
        assert 1 <= r <= m <= max(1, 2**p)
        assert all(decontaminate._missed(q, m, r, 0.8) <= 1e-9 or r == 1 for q in (2**p, 2**(p + 1) - 1))


@pytest.mark.parametrize("block", [256, 4])
def test_near_copies(docs, rows, block):
    got = ngram_join.near_copies(docs, block=block).collect()
    known = dict((i, t) for i, t in rows if i is not None)
    want = brute.near(list(known.items()))
    assert len(got) == len(rows)
    for r in got:
        expected = want[r["doc_id"]] if r["doc_id"] is not None else (None, None, None)
        assert (r["class_id"], r["rep_id"], r["n_links"]) == expected, r


def test_one_of_each(docs, rows, no_docs):
    known = dict((i, t) for i, t in rows if i is not None)
    keep = [i for i, (c, _, _) in brute.near(list(known.items())).items() if i == c]
    left = ngram_join.one_of_each(docs)
    assert left.columns == docs.columns
    assert bag((r["doc_id"],) for r in left.collect()) == bag([(i,) for i in keep] + [(None,), (None,)])
    assert ngram_join.near_copies(no_docs).count() == 0


def test_rows_that_share_an_id_are_told_apart(spark):
    rng = random.Random(9)
    a, b, c = (" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(3))
    rows = [(1, a, 1), (1, b, 2), (2, c, 3), (2, c, 4), (3, c, 5), (3, "short text", 6), (3, None, 7), (4, b, 8), (None, a, 9), (None, a, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _llm_id long")      # a column named as helper columns are
    left = ngram_join.one_of_each(df)
    assert left.columns == df.columns
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect())
    assert got == sorted([(1, a), (1, b), (2, c), (3, "short text"), (3, ""), (0, a), (0, a)])


def test_contaminated_rows_go_alone(spark, docs):
    rng = random.Random(10)
    item = [f"w{rng.randrange(500)}" for _ in range(20)]
    rows = [(None, "clean text of a row without an id and more", 1), (None, "see " + " ".join(item) + " end", 2), (7, "before " + " ".join(item[:13]), 3),
            (7, " ".join(item[9:]) + " after", 4), (8, " ".join(item), 5), (8, "another clean text under that id here", 6), (9, None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _llm_id long")
    left = decontaminate.clean(df, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert left.columns == df.columns and sorted(r["_llm_id"] for r in left.collect()) == [1, 3, 4, 6, 7]


def test_prefix_length_reaches_recall():
    k = ngram_join.prefix_length()
    assert 1 - (1 - 0.8**k) ** ngram_join.TREES >= ngram_join.RECALL > 1 - (1 - 0.8**(k + 1)) ** ngram_join.TREES


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(0, 60)] + [(200, k) for k in range(201, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r["u"]: r["v"] for r in components.components(spark.createDataFrame([*edges, (None, 3), (7, 7)], "u long, v long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


PERSONAL = ["mail a.b@x.example.com, c@d@e.org now", "ip 1.2.3.4 and 300.1.1.1 and 1.2.3.4.5.6.7.8", "4111 1111 1111 1111 or 4111-1111-1111-1112",
            "+1 (743) 555-3824, +49 30 1234567", "x@y", "@@a@b.c", "+1+1+1234567890", "9" * 5000, "a" * 5000 + "@" + "b" * 10, "é😀 4111111111111111 é",
            "1.02.003.0004", "12345678901234567890123", "%@-.-", "a@b.c@d.e", "+12345 678-90)", "\x1c4111111111111111\n+1 555 555 5555\n"]


@pytest.mark.parametrize("text", PERSONAL)
def test_base_spans(text):
    assert pii.base_spans(text) == brute.base_spans(text)


def test_base_spans_on_random_texts():
    rng = random.Random(2)
    for _ in range(3000):
        t = "".join(rng.choice("a0159@.+-() %\né") for _ in range(rng.randrange(40)))
        assert pii.base_spans(t) == brute.base_spans(t), t


def test_personal_data_adds_spans_and_masks(spark, docs, rows, no_docs):
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.fit(source.where("doc_id % 2 = 0"))
    held_out = [r["text"] for r in source.where("doc_id % 2 = 1 and text is not null").collect()]
    secrets = found = 0
    for t in held_out:
        spans = pii.find(t, model)
        assert [s for s in spans if s in pii.base_spans(t)] == pii.base_spans(t)
        wanted = {(m.start(1), m.end(1)) for m in re.finditer(r'token = "([0-9a-f]{20,})"', t)}
        secrets += len(wanted)
        found += len(wanted & {s[:2] for s in spans})
    assert secrets and found >= 0.9 * secrets
    extra = spark.createDataFrame([(k, t, "x") for k, t in enumerate([*PERSONAL, None, ""])], "doc_id long, text string, spans string")
    for r in pii.detect(extra, model).collect():
        text = [*PERSONAL, None, ""][r["doc_id"]] or ""
        spans = brute.base_spans(text)
        assert r["base_sha256"] == hashlib.sha256(pii.joined(spans).encode()).hexdigest()
        assert set(pii.joined(spans).split(",")) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[2] == k for s in spans) for k in pii.BASE]
    masked = {r["doc_id"]: r["text"] for r in pii.redact(extra, model).collect()}
    assert masked[0].startswith("mail [EMAIL], [EMAIL]@e.org") or masked[0].startswith("mail [EMAIL],")
    assert masked[len(PERSONAL)] is None and masked[len(PERSONAL) + 1] == ""
    assert pii.detect(docs, pii.Model()).count() == len(rows) and pii.detect(no_docs, pii.fit(no_docs)).count() == 0


def weights(**features):
    return pii.Model({k: np.array([9.0 if kind == v else -9.0 for kind in pii.KINDS]) for k, v in features.items()} | {"bias": np.full(5, -2.0)})


def test_long_dense_runs_are_decoded_whole():
    rng = random.Random(6)
    text, want = "", []
    for k in range(600):
        text += f"row {k} "
        want.append((len(text), len(text) + 14, "phone"))
        text += f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)} "
    assert pii.find(text, weights(ten="phone")) == want


def test_decoding_token_by_token_is_exact():
    rng, model = random.Random(8), weights(ten="phone", luhn="card", tokens="ip")
    model.weights |= {f"shape={s}": np.array([rng.uniform(-3, 6) for _ in pii.KINDS]) for s in ("9", "9 9", "9 9 9", "9-9", "9 a 9", "a9", "a9 9", "9-9 9")}
    for n in (5, 60, 3000):
        text = " ".join(rng.choice(["1", "22", "a", "b7", "3-4", "555", "x y z u v"]) for _ in range(n))
        want = []
        for tokens in map(list, pii.stretches(text)):
            best, path = [0.0], [[]]
            for j in range(1, len(tokens) + 1):
                ways = [(best[j - 1], path[j - 1])]
                for i in range(max(0, j - pii.LONGEST), j):
                    for e, f in pii.starting(text, tokens, i):
                        s = model.scores(f)
                        if e == j:
                            ways.append((best[i] + s.max(), (path[i], (tokens[i][0], tokens[j - 1][1], pii.KINDS[int(s.argmax())]))))
                top = max(ways, key=lambda w: w[0])
                best.append(top[0])
                path.append(top[1])
            found, at = [], path[-1]
            while at:
                found.append(at[1])
                at = at[0]
            want += found[::-1]
        got = [s for tokens in pii.stretches(text) for s in model.decode(text, tokens)]
        assert got == want and (got or n == 5)


@pytest.mark.parametrize("size", [64, 300, 1500])
def test_long_secrets_are_added_and_masked(spark, size):
    rng, model = random.Random(size), weights(hex="secret")
    secret = "".join(rng.choice("0123456789abcdef") for _ in range(size)) + "7a"
    text = f'before token = "{secret}" after'
    assert pii.find(text, model) == [(16, 16 + len(secret), "secret")]
    assert pii.redact(spark.createDataFrame([(text,)], "text string"), model).first()[0] == 'before token = "[SECRET]" after'
    trained = pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert (16, 16 + len(secret), "secret") in pii.find(text, trained)


def test_suffix_dedup(docs, rows, no_docs, monkeypatch):
    small = docs.where("doc_id is null or doc_id <> 48")
    kept_rows = [(i, t) for i, t in rows if i != 48]
    want = []
    for (i, _), (b, gone) in zip(kept_rows, brute.bytes_removed(kept_rows)):
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    assert bag(map(tuple, suffix_dedup.dedup(small, with_kept=False).collect())) == bag(want)
    monkeypatch.setattr(suffix_dedup.answers_of, "__defaults__", (suffix_dedup.LENGTH, 40))     # many turns a bucket
    monkeypatch.setattr(suffix_dedup, "OF_SPLITTER", 10_000)
    assert bag(map(tuple, suffix_dedup.dedup(small, with_kept=False).collect())) == bag(want)
    assert sum(w[2] for w in want) > 0
    assert suffix_dedup.dedup(no_docs).count() == 0


def test_multikey_sort():
    rng = random.Random(9)
    strings = [bytes(rng.choice(b"ab") for _ in range(20)) for _ in range(400)] + [b"ab" * 10] * 5
    data = np.frombuffer(b"".join(s.ljust(24, b"\0") for s in strings), np.uint8)
    order, group = suffix_dedup.multikey_sort(suffix_dedup.characters(data, np.arange(len(strings)) * 24, (0, 8, 16)))
    ordered = [strings[k] for k in order]
    assert ordered == sorted(strings)
    assert all((ordered[k] == ordered[k - 1]) == (group[k] == group[k - 1]) for k in range(1, len(order)))


def test_phrase_dedup(docs, rows, no_docs):
    want = []
    for (i, _), (w, gone) in zip(rows, brute.words_removed(rows)):
        want.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    assert bag(map(tuple, phrase_dedup.dedup(docs, with_kept=False).collect())) == bag(want)
    assert sum(w[2] for w in want) > 0
    assert phrase_dedup.dedup(no_docs).count() == 0


def shared_passage(spark):
    """400 documents with one passage in different texts, some of them with the same left side."""
    rng = random.Random(21)
    passage = " ".join(f"licence{k}" for k in range(45))
    left = [" ".join(f"w{rng.randrange(400)}" for _ in range(40)) for _ in range(390)]
    rows = [(k, f"{left[k % 390]} {passage} " + " ".join(f"w{rng.randrange(400)}" for _ in range(40))) for k in range(400)]
    rows += [(None, rows[0][1]), (3, rows[5][1])]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("kind", [repeats.Kind(50, 16, False), repeats.Kind(35, 8, True)])
def test_no_task_holds_all_contexts_of_an_anchor(spark, kind):
    table = repeats.chunks(shared_passage(spark)[1])
    masks, buckets, many = repeats.repeated_anchors(table, kind, most=30)
    held = repeats.slices(table, masks, buckets, kind).groupBy("key").count()
    assert many and held.agg(F.max("count")).first()[0] <= 30
    masks, buckets, many = repeats.repeated_anchors(table, kind)
    assert not many and repeats.slices(table, masks, buckets, kind).groupBy("key").count().agg(F.max("count")).first()[0] > 300


@pytest.mark.parametrize("most", [0, 30])
def test_dedup_of_anchors_with_many_contexts(spark, most):
    rows, docs = shared_passage(spark)
    want = [(i, len(b), sum(gone), hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
            for (i, _), (b, gone) in zip(rows, brute.bytes_removed(rows))]
    assert bag(map(tuple, suffix_dedup.dedup(docs, with_kept=False, most=most).drop("n_spans").collect())) == bag(want)
    want = [(i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
            for (i, _), (w, gone) in zip(rows, brute.words_removed(rows))]
    assert bag(map(tuple, phrase_dedup.dedup(docs, with_kept=False, most=most).collect())) == bag(want)


def test_anchors_with_equal_leading_bytes_are_parted():
    data = np.frombuffer(b"".join(b"        %08d" % k for k in range(100)) + b"\0" * 100, np.uint8)
    lead = suffix_dedup.leads(data, np.arange(100) * 16)
    assert len(np.unique(np.searchsorted(lead[[25, 50, 75]], lead, side="right"))) == 4


def test_turns_keep_keys_whole():
    keys = sorted([1] * 5 + [2] * 30 + [3] + [4] * 7 + [5] * 2)
    batches = [pa.RecordBatch.from_pydict({"key": keys[k:k + 4]}) for k in range(0, len(keys), 4)]
    got = [t["key"].tolist() for t in repeats.turns(batches, 6)]
    assert sum(got, []) == keys and len(got) > 1
    assert all(not set(a) & set(b) for a, b in zip(got, got[1:]))


def test_written_keeps_rows(docs, rows):
    assert written(docs, "t").agg(F.count("*")).first()[0] == len(rows)
