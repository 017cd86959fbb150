"""Near copies by shingle Jaccard similarity: a MinHash LSH forest with exact verification.

1. Every text becomes its set of five-word shingles. Texts with the same set are one class; the least id
   represents it, and only representatives are compared.
2. Each representative has one signature in each of ``TREES`` tries. A trie's paths are signature prefixes;
   ``prefix_length`` starts at the longest path and shortens the match until the forest finds a pair at the
   threshold with the wanted recall. Representatives under one trie node are candidates.
3. Candidate groups come from star edges (each member to its node's least member) and their components.
   A group of up to ``BLOCK`` members is verified as a whole in one task; a larger one is not gathered but
   verified node by node, each node cut into blocks whose pairs are separate tasks, and a pair counts only
   in the first trie where it meets. All similarities come from exact set intersections (a blocked
   incidence product); only counts per member leave a task, never pairs.
4. Links join into classes (``components``); copies get the result of their representative.

Result per document: ``class_id`` (least id of its class), ``rep_id`` (least id with the same shingles),
``n_links`` (other texts at or above the threshold) and ``n_copies`` (documents with the same shingles).

Edge cases: null text is empty; a text without words has no set, links to nothing and is its own class;
1 to 4 words are one shingle; rows without ``doc_id`` take no part and get a null class; repeated rows are
copies, and different texts under one id share one node; extra columns are ignored. Texts
of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, sized, written
from .components import components
from .shingling import mix, shingle_set

THRESHOLD, RECALL = 0.8, 0.9999
TREES, LONGEST = 32, 10
#: Members that one task compares with one another, and shingles of one slice of the incidence product.
BLOCK, SLICE = 256, 4096


def prefix_length(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, longest: int = LONGEST) -> int:
    """Shorten the matched prefix until a pair at the threshold meets in some trie with the wanted chance."""
    for k in range(longest, 1, -1):
        if 1 - (1 - threshold**k) ** trees >= recall:
            return k
    return 1


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def signature(shingles: np.ndarray, length: int, trees: int = TREES) -> np.ndarray:
    """One 64-bit path of ``length`` MinHash values for each trie."""
    a, b = _permutations(trees * length)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(trees * length, 2**32 - 1, np.uint32)
    for lo in range(0, len(x), 2048):
        np.minimum(least, (x[lo:lo + 2048, None] * a + b).min(axis=0), out=least)
    path = np.arange(1, trees + 1, dtype=np.uint64)
    for v in least.reshape(trees, length).T.astype(np.uint64):
        path = mix(path * np.uint64(0x9E3779B97F4A7C15) + v)
    return path.view(np.int64)


def _key(shingles: bytes) -> bytes:
    return hashlib.blake2b(shingles, digest_size=16).digest()


SKETCH = "doc_id long, n_shingles long, key binary, paths array<long>"


def sketches(docs: DataFrame, length: int, trees: int = TREES) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("paths", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, paths = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py() or "")
                n.append(len(s))
                keys.append(_key(s.tobytes()) if len(s) else None)
                paths.append(signature(s, length, trees) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(paths, pa.list_(pa.int64()))], schema=schema)

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, SKETCH)


def _sets(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("rep", pa.int64()), ("key", pa.binary()), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py() or "").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([_key(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())], schema=schema)

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "rep long, key binary, shingles binary")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by slices of the shingles that occur in two sets or more."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    shared = times[place] > 1
    owner, place = owner[shared], column[place[shared]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((n, n), np.int64)
    for lo in range(0, int(place[-1]) + 1 if len(place) else 0, SLICE):
        a, b = np.searchsorted(place, [lo, lo + SLICE])
        m = np.zeros((n, SLICE), np.float32)
        m[owner[a:b], place[a:b] - lo] = 1
        out += (m @ m.T).astype(np.int64)
    return out


def verify(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Link counts and local leaders of one unit: ``rep, shingles, paths, tree, lo, hi, block``."""
    rows = rows.sort_values("rep").reset_index(drop=True)
    sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
    size = np.array([len(s) for s in sets], np.int64)
    both = intersections(sets)
    link = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(link, False)
    tree, block = int(rows["tree"].iloc[0]), rows["block"].to_numpy()
    if rows["lo"].iloc[0] != rows["hi"].iloc[0]:
        link &= block[:, None] != block[None, :]
    if tree >= 0:  # a pair counts in the first trie where it meets
        paths = np.array([np.asarray(p, np.int64) for p in rows["paths"]])
        for t in range(tree):
            link &= paths[:, t][:, None] != paths[:, t][None, :]
    leader, before = np.arange(len(rows)), None
    while before is None or (leader != before).any():
        before = leader
        leader = np.minimum(leader, np.where(link, leader[None, :], len(rows)).min(axis=1))
    ids = rows["rep"].to_numpy()
    return pd.DataFrame({"rep": ids, "n_links": link.sum(axis=1), "leader": ids[leader], "tree": tree})


def near_copies(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, class_id, rep_id, n_links, n_copies``."""
    return _classes(docs, threshold, recall, block).drop("key")


def _classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """The rows of ``near_copies`` with the ``key`` of the row's shingle set."""
    percent = round(100 * threshold)
    sketch = written(sketches(docs, prefix_length(threshold, recall)), "sketch")
    classes = written(
        sketch.where("doc_id IS NOT NULL AND key IS NOT NULL").groupBy("key")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"), F.any_value("paths").alias("paths")), "classes")
    nodes = classes.select("rep", F.posexplode("paths").alias("tree", "path"))
    hubs = nodes.groupBy("tree", "path").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1")
    stars = nodes.join(hubs, ["tree", "path"]).where("rep <> hub").select(F.col("rep").alias("u"), F.col("hub").alias("v"))
    tied = components(stars)
    groups = tied.groupBy("v").agg((F.count("*") + 1).alias("members"))
    ties = tied.select(F.col("u").alias("rep"), F.col("v").alias("root")).union(
        groups.select(F.col("v").alias("rep"), F.col("v").alias("root")))
    members = written(ties.join(groups, F.col("root") == groups["v"]).select("rep", "root", "members"), "members")

    small = members.where(F.col("members") <= block).join(classes.select("rep", "key"), "rep").select(
        "rep", "key", F.lit(-1).alias("tree"), F.col("root").alias("path"), F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(0).alias("block"),
        F.lit(None).cast("array<long>").alias("paths"))
    crowd = classes.select("rep", "key", "paths").join(members.where(F.col("members") > block).select("rep"), "rep")
    met = crowd.select("rep", "key", "paths", F.posexplode("paths").alias("tree", "path"))
    cuts = (met.groupBy("tree", "path").agg(F.count("*").alias("n")).where("n > 1")
            .select("tree", "path", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    met = met.join(cuts, ["tree", "path"]).withColumn("block", F.pmod(F.xxhash64("rep", "tree"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    large = met.select("rep", "key", "tree", "path", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "paths")

    asked = members.select(F.col("rep").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sized(asked), "doc_id", "left_semi")
    sets = _sets(texts)
    if _repeats(sketch):
        sets = sets.groupBy("rep", "key").agg(F.any_value("shingles").alias("shingles"))
    units = sets.join(small.unionByName(large), ["rep", "key"])
    checked = written(
        units.groupBy("tree", "path", "lo", "hi").applyInPandas(
            lambda rows: verify(rows, percent), "rep long, n_links long, leader long, tree int"), "checked")
    links = checked.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    joined = components(checked.where("rep <> leader").select(F.col("rep").alias("u"), F.col("leader").alias("v")))
    found = written(
        classes.select("key", "rep", "n_copies").join(links, "rep", "left")
        .join(joined.select(F.col("u").alias("rep"), F.col("v").alias("class_id")), "rep", "left")
        .select("key", F.coalesce("class_id", "rep").alias("class_id"), F.col("rep").alias("rep_id"),
                F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies"), "linked")
    seen = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return sketch.select("doc_id", "key").join(found, "key", "left").select(
        "key", "doc_id", seen.alias("class_id"), F.when(F.col("doc_id").isNotNull(), F.coalesce("rep_id", "doc_id")).alias("rep_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_copies", F.lit(1))).cast("long").alias("n_copies"))


def _repeats(sketch: DataFrame) -> bool:
    """Whether some id has several rows."""
    r = sketch.agg(F.count("doc_id").alias("n"), F.count_distinct("doc_id").alias("d")).first()
    return r["n"] != r["d"]


def _keyed(rows: DataFrame) -> DataFrame:
    """``_row`` with ``doc_id``, ``text`` and the key of the text's shingle set."""
    schema = T.StructType([*rows.schema.fields, T.StructField("key", T.BinaryType())])

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py() or "") for t in batch.column("text")]
            keys = pa.array([_key(s.tobytes()) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "key"])

    return map_batches(rows, run, schema)


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The least document of every class, once; rows without an id stay.

    Rows that share an id are told apart by their shingle sets: of those with the same set one stays, unlike texts stay
    or go by their own classes."""
    found = written(_classes(docs, threshold), "near")
    drop = written(found.where("doc_id <> class_id").select(F.col("doc_id").alias("_llm_id")).distinct(), "copies")
    again = written(found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_llm_id")).agg(F.count("*").alias("n")).where("n > 1").select("_llm_id"), "again")
    whole = docs.select(F.col("doc_id").cast("long").alias("_llm_doc_id"), F.col("text").alias("_llm_text"), F.struct(*docs.columns).alias("_row"))  # any column names
    on = F.col("_llm_doc_id") == F.col("_llm_id")
    if again.isEmpty():
        return whole.join(sized(drop), on, "left_anti").select("_row.*")
    single = whole.join(sized(again), on, "left_anti").join(sized(drop), on, "left_anti").select("_row.*")
    several = _keyed(whole.join(sized(again), on, "left_semi").select(F.col("_llm_doc_id").alias("doc_id"), F.col("_llm_text").alias("text"), "_row"))
    kept = found.join(sized(again), F.col("doc_id") == F.col("_llm_id"), "left_semi").where("doc_id = class_id").select("doc_id", "key").distinct()
    one = several.join(kept.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")), (F.col("doc_id") == F.col("_id")) & F.col("key").eqNullSafe(F.col("_key")), "left_semi")
    return single.unionByName(one.groupBy("doc_id", "key").agg(F.min_by("_row", F.struct("text")).alias("_row")).select("_row.*"))
