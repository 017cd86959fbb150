"""Near copies by bottom-k sketches from one hash function.

1. Every text becomes the set of its hashed three-word shingles; its sketch is the ``KEPT`` least values of that set, so
   the sketch of a union is found from the two sketches. Texts with the same set are one class; only classes go on.
2. Inverted lists: every retained value lists the classes whose sketch holds it. Two sets at the threshold share at least
   ``needed`` sketch values (but for a chance below ``MISS``), so a class is listed only under its rarest
   ``size - needed + 1`` values (rare by counted lists, ties by value): two such sets still meet, and the values of
   boilerplate list nobody who has rarer ones.
3. First pass: every member of a list against the list's most central member, whose values are on the longest lists.
   The union sketch estimates the similarity and drops pairs that cannot reach the threshold; the rest is confirmed on the
   full sets. Members linked with the same one are one party.
4. Second pass: lists that still hold several parties, those with one central member together. All members outside the
   largest party (of the lists together, or of each list, where that takes fewer comparisons) meet all members, in blocks
   by blocks; again sketches first, full sets after. Pairs of one party need no look, so a large group of near copies
   costs about one comparison a member.

No pairs leave a task of step 4, only a leader for each member. Every pair of one list is either compared or linked
through its party, so the components of what is found are those of all links.

Edge cases: a null text has no words; a text without words has the empty set, is linked with nothing and is its own
component; one or two words are one shingle. Rows without ``doc_id`` get null component and kept. Repeated rows are
copies; unlike texts under one id are one node, whose links are united. Extra columns are ignored whatever their names;
empty tables give no rows. Texts of any length are read whole; blocks are bounded by members and by shingles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import map_batches, sized, written
from .components import components
from .shingling import window_hashes

SIZE, PERCENT, KEPT, MISS = 3, 85, 64, 1e-9
#: Members and shingles of one block; shingles of one slice of the incidence product; pairs that are compared one by one.
BLOCK, BLOCK_SHINGLES, SLICE, FEW = 256, 1_000_000, 4096, 64


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text whose A-Z are lower-cased (bytes.lower() changes no others)."""
    words = (text or "").encode().lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return np.unique(window_hashes(h, min(size, len(h)))) if len(h) else h


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def seen_of_union(kept: int = KEPT, percent: int = PERCENT, miss: float = MISS) -> int:
    """Least hits among ``kept`` draws from a union of which ``percent`` is shared, but for a chance below ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(kept + 1):
        below += math.comb(kept, t) * p**t * (1 - p) ** (kept - t)
        if below > miss:
            return max(t, 1)
    return kept


def needed(size: Column, kept: int = KEPT, percent: int = PERCENT) -> Column:
    """Sketch values that a sketch of ``size`` values shares with that of any set at the threshold.

    A whole set as sketch (``size`` < ``kept``) may miss one in ``(100 - percent) / percent`` of its values, however
    large the other set; longer sets go by the chance of the draw.
    """
    whole = F.ceil(size * (2 * percent - 100) / percent)
    return F.greatest(F.lit(1), F.when(size < kept, whole).otherwise(seen_of_union(kept, percent))).cast("int")


SKETCH = "doc_id long, n_shingles long, key binary, sketch array<long>"


def sketches(docs: DataFrame, kept: int = KEPT) -> DataFrame:
    """One row per document. Values lose their lowest bit, which leaves them positive and in order."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, least = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py())
                sizes.append(len(s))
                keys.append(_key(s) if len(s) else None)
                least.append((s[:kept] >> np.uint64(1)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(least, pa.list_(pa.int64()))], schema=schema)

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SKETCH)


def may_link(a: Column, b: Column, kept: int = KEPT, percent: int = PERCENT) -> Column:
    """Whether two sketches leave the threshold possible: exact where both sets are whole, else by the union's sketch."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, kept)
    hits = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) < kept, 100 * hits >= percent * F.size(union)).otherwise(hits >= seen_of_union(kept, percent))


def inverted_lists(classes: DataFrame) -> DataFrame:
    """``value, key, rep, n_shingles, central``: classes under the rarest values of their sketches (a written table).

    ``central`` is the summed length of all lists that the sketch is on."""
    held = classes.select("key", "rep", "n_shingles", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    often = held.groupBy("value").agg(F.count("*").alias("lists")).where("lists > 1")
    met = held.join(often, "value")
    mine = W.partitionBy("key", "rep")
    ranked = met.withColumn("met", F.count("*").over(mine)).withColumn("central", F.sum("lists").over(mine)).withColumn("place", F.row_number().over(mine.orderBy("lists", "value")))
    room = F.col("size") - needed(F.col("size")) + 1 - (F.col("size") - F.col("met"))  # values of no other class come first
    return written(ranked.where(F.col("place") <= room).select("value", "key", "rep", "n_shingles", "central"), "lists")


# -- full sets ---------------------------------------------------------------------------------------------

def sets_of(docs: DataFrame, reps: DataFrame, repeats: bool) -> DataFrame:
    """``rep, key, shingles``: full sets of the documents whose ids are in ``reps``."""
    schema = pa.schema([("rep", pa.int64()), ("key", pa.binary()), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array([_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(sized(reps), "rep", "left_semi")
    found = map_batches(texts, run, "rep long, key binary, shingles binary")
    return found.groupBy("rep", "key").agg(F.any_value("shingles").alias("shingles")) if repeats else found


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, by slices of the shingles that both sides hold."""
    out = np.zeros((len(left), len(right)), np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    if not len(shared):
        return out

    def placed(sets, flat):
        at = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
        ok = shared[at] == flat
        owner, at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[ok], at[ok]
        order = np.argsort(at, kind="stable")
        return owner[order], at[order]

    (who_a, at_a), (who_b, at_b) = placed(left, a), placed(right, b)
    for lo in range(0, len(shared), SLICE):
        m, n = np.zeros((len(left), SLICE), np.float32), np.zeros((len(right), SLICE), np.float32)
        i, j = np.searchsorted(at_a, [lo, lo + SLICE])
        m[who_a[i:j], at_a[i:j] - lo] = 1
        i, j = np.searchsorted(at_b, [lo, lo + SLICE])
        n[who_b[i:j], at_b[i:j] - lo] = 1
        out += (m @ n.T).astype(np.int64)
    return out


def possible(left: list[np.ndarray], right: list[np.ndarray], kept: int = KEPT, percent: int = PERCENT) -> np.ndarray:
    """The union-sketch estimate of all pairs of a tile, with all shared sketch values as hits: never below ``may_link``."""
    shared = overlaps([s[:kept] for s in left], [s[:kept] for s in right])
    n = [np.array([len(x) for x in s], np.int64) for s in (left, right)]
    union = n[0][:, None] + n[1][None, :] - shared
    whole = (n[0] < kept)[:, None] & (n[1] < kept)[None, :] & (union < kept)
    return np.where(whole, 100 * shared >= percent * union, shared >= seen_of_union(kept, percent))


def linked(sets: list[list[np.ndarray]], comps: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Which sets of the left side are linked with which of the right; pairs of one component are not looked at."""
    n = [np.array([len(x) for x in s], np.int64) for s in sets]
    link = (comps[0][:, None] != comps[1][None, :]) & (100 * np.minimum(n[0][:, None], n[1]) >= percent * np.maximum(n[0][:, None], n[1]))
    if link.sum() <= FEW:
        for i, j in zip(*np.nonzero(link)):
            both = len(np.intersect1d(sets[0][i], sets[1][j], assume_unique=True))
            link[i, j] = 100 * both >= percent * (n[0][i] + n[1][j] - both)
        return link
    link &= possible(*sets, percent=percent)
    rows, columns = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
    if len(rows):
        both = overlaps([sets[0][k] for k in rows], [sets[1][k] for k in columns])
        at = np.ix_(rows, columns)
        link[at] &= 100 * both >= percent * (n[0][rows][:, None] + n[1][columns][None, :] - both)
    return link


def verified(rows: pd.DataFrame, percent: int = PERCENT) -> pd.DataFrame:
    """``u, v``: every member that is linked in one of these tiles, with the least node it is linked to (the other side's,
    where that has one member). ``list, a, b, side, rep, comp, shingles``."""
    far, out = np.iinfo(np.int64).max, [np.zeros((0, 2), np.int64)]
    ids, comps, sides = (rows[c].to_numpy() for c in ("rep", "comp", "side"))
    blobs = rows["shingles"].to_numpy()
    for places in rows.groupby(["list", "a", "b"], sort=False).indices.values():
        two = [places[sides[places] == s] for s in (0, 1)]
        if not len(two[0]) or not len(two[1]):
            continue
        sets = [[np.frombuffer(blobs[k], np.uint64) for k in t] for t in two]
        link = linked(sets, [comps[t] for t in two], percent)
        if not link.any():
            continue
        if len(two[0]) == 1:
            mine = ids[two[1]][link[0]]
            out.append(np.column_stack([mine, np.full(len(mine), ids[two[0][0]])]))
            continue
        lead, before = [ids[t].copy() for t in two], None
        while before is None or any((x != y).any() for x, y in zip(lead, before)):
            before = [x.copy() for x in lead]
            lead[0] = np.minimum(lead[0], np.where(link, lead[1][None, :], far).min(axis=1))
            lead[1] = np.minimum(lead[1], np.where(link, lead[0][:, None], far).min(axis=0))
        out.append(np.column_stack([np.concatenate([ids[t] for t in two]), np.concatenate(lead)]))
    pairs = np.unique(np.concatenate(out), axis=0)
    return pd.DataFrame(pairs[pairs[:, 0] != pairs[:, 1]], columns=["u", "v"])


def links_of(tiles: DataFrame, sets: DataFrame) -> DataFrame:
    """Links found in tiles ``list, a, b, side, rep, key, comp, n_shingles`` (a written table).

    A task takes several tiles, about ``BLOCK_SHINGLES`` shingles or one large tile."""
    total = tiles.agg(F.sum("n_shingles")).first()[0] or 0
    bundles = max(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BLOCK_SHINGLES))
    full = tiles.withColumn("bundle", F.pmod(F.xxhash64("list", "a", "b"), F.lit(bundles))).join(sets, ["rep", "key"])
    return written(full.select("bundle", "list", "a", "b", "side", "rep", "comp", "shingles").groupBy("bundle").applyInPandas(lambda rows: verified(rows), "u long, v long"), "links")


def _blocks(members: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(members / BLOCK), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("key", "list"), blocks).cast("int")


TILE = ["list", "a", "b", "side", "rep", "key", "comp", "n_shingles"]


def with_hubs(lists: DataFrame) -> DataFrame:
    """The lists of two members or more, each row with the list's most central member (a written table)."""
    hubs = lists.groupBy("value").agg(F.min(F.struct((-F.col("central")).alias("out"), "rep", "key", "n_shingles")).alias("hub"), F.count("*").alias("n")).where("n > 1")
    return written(lists.join(hubs, "value").select("value", "rep", "key", "n_shingles", F.col("hub.rep").alias("hub"), F.col("hub.key").alias("hub_key"),
                                                    F.col("hub.n_shingles").alias("hub_shingles")), "hubs")


def first_pass(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """Tiles of every list's most central member against the others that the union sketch leaves (a written table)."""
    pairs = lists.where("key <> hub_key").select("rep", "key", "n_shingles", "hub", "hub_key", "hub_shingles").distinct()
    one, two = classes.select("key", "sketch"), classes.select(F.col("key").alias("hub_key"), F.col("sketch").alias("hub_sketch"))
    left = written(pairs.join(one, "key").join(two, "hub_key").where(may_link(F.col("sketch"), F.col("hub_sketch"))).drop("sketch", "hub_sketch"), "pairs")
    counts = left.groupBy("hub_key").agg(_blocks(F.count("*"), F.sum("n_shingles")).alias("blocks"))
    dealt = left.join(counts, "hub_key").withColumn("list", F.col("hub_key")).withColumn("b", _block(F.col("blocks"))).withColumn("a", F.lit(0))
    others = dealt.withColumn("side", F.lit(1)).withColumn("comp", F.lit(1).cast("long")).select(*TILE)
    heads = dealt.select("list", "a", "b", F.lit(0).alias("side"), F.col("hub").alias("rep"), F.col("list").alias("key"), F.lit(0).cast("long").alias("comp"),
                         F.col("hub_shingles").alias("n_shingles")).distinct()
    return written(others.unionByName(heads), "tiles")


def _open(members: DataFrame, unit: str) -> DataFrame:
    """Units (``unit``) that hold several components: sizes, the largest component and its sizes, a checksum of the members."""
    parts = members.groupBy(unit, "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"), F.expr("bit_xor(xxhash64(key))").alias("x"), F.expr("bit_xor(xxhash64(key, 1))").alias("y"))
    most = F.struct("n", "comp", "w")
    return parts.groupBy(unit).agg(F.max(most).alias("main"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.count("*").alias("comps"), F.min("comp").alias("least"),
                                   F.expr("bit_xor(x)").alias("x"), F.expr("bit_xor(y)").alias("y")).where("comps > 1")


def parties(edges: DataFrame) -> DataFrame:
    """``u, comp``: nodes with a node that they are linked to, directly or by way of one other."""
    one = edges.groupBy("u").agg(F.min("v").alias("v"))
    two = one.select(F.col("u").alias("v"), F.col("v").alias("w"))
    return one.join(two, "v", "left").select("u", F.least("v", F.coalesce("w", "v")).alias("comp"))


def second_pass(lists: DataFrame, edges: DataFrame) -> DataFrame:
    """Tiles of the members outside the largest party of a group of lists, or of each list, against all members (a written table)."""
    known = lists.select("value", "hub_key", "rep", "key", "n_shingles").join(parties(edges).withColumnRenamed("u", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    open_lists = _open(known, "value")
    cost = (F.col("n") - F.col("main.n")) * F.col("n")
    met = written(known.join(open_lists.select("value"), "value"), "open")
    members = met.select(F.col("hub_key").alias("group"), "rep", "key", "n_shingles", "comp").distinct()
    of = met.select("value", F.col("hub_key").alias("group")).distinct()
    by_list = open_lists.join(of, "value").groupBy("group").agg(F.sum(cost).alias("by_list"))
    sizes = written(_open(members, "group").withColumn("whole", cost).join(by_list, "group"), "groups")
    together = (F.col("n") <= BLOCK) | (F.col("whole") <= F.col("by_list"))
    whole = sizes.where(together)
    apart = sizes.where(~together).select("group").join(of, "group").join(open_lists, "value")
    # lists with the same members are looked at once
    apart = apart.groupBy("n", "x", "y").agg(F.min(F.struct("value", "main", "w")).alias("l")).select("n", "l.*")

    def tiles(rows: DataFrame, units: DataFrame, unit: str, mark: str) -> DataFrame:
        cut = units.select(unit, F.col("main.comp").alias("largest"), _blocks(F.col("n") - F.col("main.n"), F.col("w") - F.col("main.w")).alias("rows"), _blocks(F.col("n"), F.col("w")).alias("columns"))
        dealt = rows.join(cut, unit).withColumn("list", F.concat(F.lit(mark).cast("binary"), F.col(unit).cast("string").cast("binary") if unit == "value" else F.col(unit)))
        everyone = dealt.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumn("b", _block(F.col("columns"))).withColumn("side", F.lit(1))
        others = dealt.where("comp <> largest").withColumn("a", _block(F.col("rows"))).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))).withColumn("side", F.lit(0))
        return everyone.select(*TILE).unionByName(others.select(*TILE))

    return written(tiles(members, whole, "group", "g").unionByName(tiles(met.drop("hub_key"), apart, "value", "v")), "tiles")


def near_copies(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    sketch = written(sketches(docs), "sketches")
    known = sketch.where("doc_id IS NOT NULL AND key IS NOT NULL")
    classes = written(known.groupBy("key").agg(F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("sketch").alias("sketch")), "classes")
    again = written(known.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).where("n > 1"), "again")
    repeats = not again.isEmpty()
    lists = with_hubs(inverted_lists(classes))

    def links(tiles: DataFrame) -> DataFrame:
        return links_of(tiles, sets_of(docs, written(tiles.select("rep").distinct(), "asked"), repeats))

    edges = links(first_pass(lists, classes))
    edges = edges.unionByName(links(second_pass(lists, edges)))
    if repeats:  # unlike texts under one id: the id joins the classes of its texts
        unlike = known.join(again.where("lo <> hi").select("doc_id"), "doc_id", "left_semi").select("doc_id", "key")
        edges = edges.unionByName(unlike.join(classes.select("key", "rep"), "key").select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))
    tied = components(edges)
    found = classes.select("key", "rep").join(tied.withColumnRenamed("u", "rep"), "rep", "left").select("key", F.coalesce("v", "rep").alias("component_id"))
    mine = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return sketch.select("doc_id", "n_shingles", "key").join(found, "key", "left").select("doc_id", "n_shingles", mine.alias("component_id"), (F.col("doc_id") == mine).alias("kept"))


#: DuckDB SQL of the registered query: all links by shared shingles, components by reachability.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + least(3, len(w)) - 1], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n m ON m.doc_id = p.a JOIN n o ON o.doc_id = p.b WHERE 100 * shared >= 85 * (m.n + o.n - shared)
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
