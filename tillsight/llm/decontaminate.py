"""Benchmark decontamination: containment search with size-partitioned MinHash sketches (DataFrame only).

Test items are put into partitions by their number q of distinct five-word shingles (powers of two). An
item's sketch is its m smallest shingle hashes. A document that holds a share t of the item holds each
sketch value with that share, so the values it hits follow a hypergeometric law; for every partition
``sketch_plan`` picks the number of hits r that a true container misses with probability below ``MISS``.
Documents of every length probe the sketches with their whole shingle sets (no window, no length limit);
the pairs with r hits are candidates and the exact share of the item's shingles decides.

Edge cases: null texts are empty; items below five words have no shingle and match nothing; rows with the
same ``item_id`` are one item with the union of their shingles, rows with the same ``doc_id`` (null
included) one document; repeated shingles count once; extra columns are ignored; empty tables give an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once, sized, written

SHINGLE, THRESHOLD = 5, 0.8
#: Longest sketch, and the chance allowed that a document at the threshold is no candidate.
SKETCH, MISS = 24, 1e-9


def plain_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _starts(words: str) -> Column:
    return F.sequence(F.lit(0), F.size(words) - SHINGLE)


def hashes(words: str) -> Column:
    """Distinct 64-bit hashes of the five-word shingles."""
    each = F.transform(_starts(words), lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(SHINGLE)]))
    return F.when(F.size(words) >= SHINGLE, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))


def shingles(words: str) -> Column:
    """Distinct five-word shingles as text."""
    each = F.transform(_starts(words), lambda i: F.array_join(F.slice(F.col(words), i + 1, SHINGLE), " "))
    return F.when(F.size(words) >= SHINGLE, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))


def _missed(q: int, m: int, r: int, threshold: float) -> float:
    """Chance that fewer than r of m sketch values lie in the ceil(t q) shingles that the document holds."""
    held = math.ceil(threshold * q - 1e-9)
    return sum(math.comb(held, k) * math.comb(q - held, m - k) for k in range(r)) / math.comb(q, m)


def sketch_plan(threshold: float = THRESHOLD, sketch: int = SKETCH, miss: float = MISS, parts: int = 21) -> list[tuple[int, int]]:
    """(m, r) for the sizes 2**p to 2**(p+1)-1; the last holds for all larger sizes as well."""
    plan = []
    for p in range(parts):
        m = min(2**p, sketch)
        sizes = sorted({2**p + k * 2**p // 16 for k in range(16)} | {2**(p + 1) - 1})
        r = 1
        while r < m and all(_missed(q, m, r + 1, threshold) <= miss for q in sizes):
            r += 1
        plan.append((m, r))
    return plan


def item_sketches(benchmark: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(item_id, shingles, n_item) and (h, item_id, n_item, needed hits): both written tables."""
    plan = sketch_plan(threshold)
    w = once(benchmark.select("item_id", "text"), ["item_id"], {"_w": plain_words(F.col("text"))})
    one = w.select("item_id", F.explode(shingles("_w")).alias("s")).distinct()
    # the same five words give the same hash as in hashes()
    one = one.withColumn("h", F.xxhash64(*[F.split("s", " ")[k] for k in range(SHINGLE)]))
    items = written(one.groupBy("item_id").agg(F.collect_list("s").alias("shingles"), F.count("*").alias("n_item")), "items")
    part = F.least(F.floor(F.log2("n_item")).cast("int"), F.lit(len(plan) - 1))
    lengths = F.array(*[F.lit(m) for m, _ in plan])
    needed = F.array(*[F.lit(r) for _, r in plan])
    counted = one.groupBy("item_id").agg(F.count("*").alias("n_item"), F.array_sort(F.collect_set("h")).alias("hs"))
    sketches = counted.select("item_id", "n_item", F.get(needed, part).alias("needed"),
                              F.explode(F.slice("hs", F.lit(1), F.get(lengths, part))).alias("h"))
    return items, written(sketches, "sketches")


def contained(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment`` of every pair at or above the threshold."""
    items, sketches = item_sketches(benchmark, threshold)
    texts = once(docs.select("doc_id", "text"), ["doc_id"], {"_w": plain_words(F.col("text"))})
    probes = once(texts, ["doc_id"], {"_h": hashes("_w")}).select("doc_id", F.explode("_h").alias("h"))
    hit = probes.join(sized(sketches), "h")
    found = written(
        hit.groupBy("doc_id", "item_id").agg(F.count_distinct("h").alias("hits"), F.max("needed").alias("needed"))
        .where("hits >= needed").select("doc_id", "item_id"), "candidates")
    asked = found.select(F.col("doc_id").alias("_id")).distinct()
    held = docs.select("doc_id", "text").join(sized(asked), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    held = once(held, ["doc_id"], {"_w": plain_words(F.col("text"))})
    held = once(held, ["doc_id"], {"_s": shingles("_w")})
    asked_items = found.select(F.col("doc_id").alias("_id"), F.col("item_id").alias("_item"))
    pairs = asked_items.join(items, F.col("_item").eqNullSafe(F.col("item_id"))).select("_id", "item_id", "shingles", "n_item")
    exact = held.join(pairs, F.col("doc_id").eqNullSafe(F.col("_id"))).select(
        "doc_id", "item_id", "n_item", F.explode(F.array_intersect("_s", "shingles")).alias("s"))
    return (exact.groupBy("doc_id", "item_id", "n_item").agg(F.count_distinct("s").alias("n_shared"))
            .where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item") - 1e-9)
            .select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment")))


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no test item, each row judged by its own text, whatever rows share its id."""
    row = F.struct("doc_id", F.xxhash64("text").alias("text"))
    whole = docs.select(row.alias("_llm_row"), F.struct(*docs.columns).alias("_llm_doc"))  # extra columns may have any name
    bad = written(contained(docs.select(row.alias("doc_id"), "text"), benchmark, threshold).select(F.col("doc_id").alias("_llm_bad")).distinct(), "contaminated")
    return whole.join(sized(bad), F.col("_llm_row").eqNullSafe(F.col("_llm_bad")), "left_anti").select("_llm_doc.*")


ORACLE = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5),
held AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM places),
item_words AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
item_places AS (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words WHERE len(w) >= 5),
items AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM item_places),
sizes AS (SELECT item_id, count(*) AS n_item FROM items GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item::DOUBLE AS containment
FROM held JOIN items USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) >= 0.8 * n_item - 1e-9
"""
