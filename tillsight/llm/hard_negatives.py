"""Hard negatives by slot-decomposed selection.

1. Vectors become integer vectors (``floor(scale * x)``), packed as bytes. Rows are dealt to blocks of bounded size and
   every anchor visits every block, so a task holds one block and streams the anchors past it; scores are exact.
2. First visit: each block keeps an anchor's best ``positives`` other rows of the same label; a ranked window over the
   blocks' survivors keeps the best of all.
3. The positives' scores are upper limits. They cut the score axis into disjoint slots, slot *s* holding the scores that
   exactly *s* limits reach. Second visit: each block keeps, by anchor and slot, the best ``negatives`` rows of another
   label that some window can still hold; a ranked window keeps the best of each slot over all blocks.
4. The window of the i-th positive is a union of slots, i and up. Merging the slots from the last to the first, each
   merge keeping the best ``negatives``, answers all of an anchor's overlapping windows; the lower limit is then a filter,
   for rows under it stand last.

Edge cases: rows with a null id, a null label, a null vector or a null or non-finite component take no part; an empty
vector scores 0; of vectors with unlike lengths the shorter is padded with zeros; scores beyond 64 bits are held at the
ends of that range. Rows under the anchor's own id are never its positives or negatives; any other repeated rows are rows
of their own, and so are unlike anchors under one id. Equal scores go by the smaller id. Empty tables give no rows; columns
other than the three named are ignored, whatever their names. Vectors of any length work; a block is bounded by rows and bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import map_batches, written

POSITIVES, NEGATIVES, LOW_PERCENT, SCALE = 5, 5, 80, 256
#: Rows and bytes of one block, and scores computed at once.
BLOCK_ROWS, BLOCK_BYTES, TILE = 262_144, 128_000_000, 4_000_000
_SMALL = 2**15

PACKED = "vec_id long, label long, wide boolean, q binary"


def _integers(x: np.ndarray, scale: int) -> list[int]:
    """Exact ``floor(scale * x)`` of doubles of any size."""
    return [int(np.floor(v * scale)) if abs(v) < 2.0**900 else int(v) * scale for v in x]


def packed(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, wide, q``: the rows that take part, components as 16-bit integers, or decimal text where they are wider."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("wide", pa.bool_()), ("q", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v")
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False))
            with np.errstate(over="ignore"):
                q = np.floor(flat * scale)
            narrow = (np.abs(q) < _SMALL)
            short = np.where(narrow, q, 0).astype("<i2")
            keep, wide, out, lo = [], [], [], 0
            for k, hi in enumerate(ends):
                if np.isfinite(flat[lo:hi]).all():
                    keep.append(k)
                    wide.append(not narrow[lo:hi].all())
                    out.append(" ".join(map(str, _integers(flat[lo:hi], scale))).encode() if wide[-1] else short[lo:hi].tobytes())
                lo = hi
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(keep), batch.column("label").take(keep), pa.array(wide, pa.bool_()), pa.array(out, pa.binary())], schema=schema)

    whole = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)")
    return map_batches(whole.select("vec_id", "label", "v"), run, PACKED)


class Matrix:
    """Integer vectors of one block or batch, as float columns where sums stay exact, else as Python integers."""

    def __init__(self, wide: list[bool], q: list[bytes]):
        rows = [np.array([int(x) for x in b.split()], object) if w else np.frombuffer(b, "<i2") for w, b in zip(wide, q)]
        dims = max(map(len, rows), default=0)
        if not any(wide) and all(len(r) == dims for r in rows):
            self.m = np.stack(rows) if rows else np.zeros((0, 0), np.int16)
        else:
            self.m = np.zeros((len(rows), dims), object if any(wide) else np.int16)
            for k, r in enumerate(rows):
                self.m[k, :len(r)] = r
        self.top = max((abs(int(x)) for x in (self.m.max(), self.m.min())), default=0) if self.m.size else 0

    def dots(self, other: Matrix, mine: slice, its: slice) -> np.ndarray:
        """Exact products of some rows of this matrix with some of the other's, held within 64 bits."""
        d = min(self.m.shape[1], other.m.shape[1])
        bound = d * self.top * other.top
        kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object
        s = self.m[mine, :d].astype(kind) @ other.m[its, :d].astype(kind).T if d else np.zeros((len(self.m[mine]), len(other.m[its])))
        return np.clip(s, -2**63, 2**63 - 1).astype(np.int64) if kind is object else s.astype(np.int64)


def first(group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of every group: higher scores first, then smaller ids."""
    order = np.lexsort((vec_id, np.invert(score), group))
    g = group[order]
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, int)
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.r_[starts, len(g)]))
    return order[rank < k]


def _at_least(score: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """``ok`` without those that ``k`` better scores of their row rule out."""
    if score.shape[1] > k:
        held = np.where(ok, score, np.iinfo(np.int64).min)
        ok = ok & (held >= np.partition(held, score.shape[1] - k, axis=1)[:, -k, None])
    return ok


def _best_of(block: dict, anchors: dict, pick, k: int) -> Iterator[tuple]:
    """The first ``k`` by anchor and slot in one block: places of anchors, slots, scores, ids. ``pick`` maps scores to slots, 0 for none."""
    rows, asked = block["matrix"], anchors["matrix"]
    wide = max(1, min(len(block["vec_id"]), 16_384))
    tall = max(1, TILE // wide)
    for a in range(0, len(anchors["key"]), tall):
        mine, found = slice(a, a + tall), []
        for b in range(0, len(block["vec_id"]), wide):
            its = slice(b, b + wide)
            score = asked.dots(rows, mine, its)
            same = anchors["label"][mine, None] == block["label"][None, its]
            own = anchors["vec_id"][mine, None] == block["vec_id"][None, its]
            who, slot, col = pick(score, same, own, mine)
            found.append((who + a, slot, score[who, col], block["vec_id"][its][col]))
        who, slot, score, ids = (np.concatenate(x) for x in zip(*found))
        best = first(who * 1024 + slot, score, ids, k)
        yield who[best], slot[best], score[best], ids[best]


def visits(rows: DataFrame, anchors: DataFrame, k: int, with_limits: bool, low_percent: int = LOW_PERCENT) -> DataFrame:
    """``key, slot, score, vec_id``: what every block keeps of its rows for every anchor."""
    spark = rows.sparkSession
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("q")).alias("bytes")).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = int(max(-(-size["n"] // BLOCK_ROWS), -(-(size["bytes"] or 0) // BLOCK_BYTES), min(tasks, -(-size["n"] // 1024)), 1))
    none = F.array().cast("array<long>")
    number = F.xxhash64(F.monotonically_increasing_id())  # of a written table: the same in every run of a task
    dealt = rows.select(F.pmod(number, F.lit(blocks)).cast("int").alias("block"), F.lit(None).cast("long").alias("key"), "vec_id", "label", "wide", "q", none.alias("limits"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "key", "vec_id", "label", "wide", "q", "limits" if with_limits else none.alias("limits"))
    schema = pa.schema([("key", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])

    def positives(score, same, own, mine):
        who, col = np.nonzero(_at_least(score, same & ~own, k))
        return who, np.ones(len(who), np.int64), col

    def negatives(limits):
        def pick(score, same, own, mine):
            lim = limits[mine]
            lowest = np.where(lim > np.iinfo(np.int64).min, lim, np.iinfo(np.int64).max).min(axis=1)
            floor = np.array([-(-low_percent * int(x) // 100) if 0 <= x < np.iinfo(np.int64).max else 0 for x in lowest], np.int64)
            ok = ~same & ~own & (score <= lim.max(axis=1)[:, None]) & (score >= floor[:, None])
            who, col = np.nonzero(ok)
            s = score[who, col]
            slot = (lim[who] >= s[:, None]).sum(axis=1)
            return who, slot, col
        return pick

    def run(batches):
        held, block, ready = [], None, None
        for batch in batches:
            numbers = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)]
            for lo, hi in zip(cuts, cuts[1:]):
                part = batch.slice(lo, hi - lo)
                if block != numbers[lo]:
                    held, block, ready = [], numbers[lo], None
                n_rows = part.column("key").null_count  # a block's rows come before the anchors
                if n_rows:
                    held.append(part.slice(0, n_rows).select(["vec_id", "label", "wide", "q"]))
                if n_rows == len(part) or not held and ready is None:
                    continue
                if ready is None:
                    t = pa.Table.from_batches(held)
                    ready = {"vec_id": t["vec_id"].to_numpy(), "label": t["label"].to_numpy(), "matrix": Matrix(t["wide"].to_pylist(), t["q"].to_pylist())}
                    held = []
                part = part.slice(n_rows)
                mine = {"key": part.column("key").to_numpy(), "vec_id": part.column("vec_id").to_numpy(), "label": part.column("label").to_numpy(),
                        "matrix": Matrix(part.column("wide").to_pylist(), part.column("q").to_pylist())}
                pick = positives
                if with_limits:
                    lists = part.column("limits").to_pylist()
                    limits = np.full((len(lists), max(map(len, lists))), np.iinfo(np.int64).min)
                    for k_, x in enumerate(lists):
                        limits[k_, :len(x)] = x
                    pick = negatives(limits)
                for who, slot, score, ids in _best_of(ready, mine, pick, k):
                    yield pa.RecordBatch.from_arrays([pa.array(mine["key"][who]), pa.array(slot.astype(np.int32)), pa.array(score), pa.array(ids)], schema=schema)

    met = dealt.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", F.col("key").asc_nulls_first(), "vec_id")
    return map_batches(met, run, "key long, slot int, score long, vec_id long")


def _first_of(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of every key over all blocks, ranked; Spark limits each group before the shuffle too."""
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(rows: DataFrame, is_anchor: Column, vec_id: Column, label: Column, vector: Column, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; at most 1023 positives an anchor.

    ``is_anchor`` is a predicate over ``vec_id``; the columns give the id, the label and the vector of a row.
    """
    table = written(packed(rows.select(vec_id.cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.cast("array<double>").alias("v")), scale), "vectors")
    anchors = written(table.where(is_anchor).withColumn("key", F.monotonically_increasing_id()), "anchors")
    liked = written(_first_of(visits(table, anchors, positives, False), ["key"], positives)
                    .select("key", F.col("place").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    limits = liked.groupBy("key").agg(F.sort_array(F.collect_list("positive_score"), asc=False).alias("limits"))
    slots = _first_of(visits(table, written(anchors.join(limits, "key"), "limits"), negatives, True, low_percent), ["key", "slot"], negatives)
    held = slots.groupBy("key").agg(F.collect_list(F.struct("slot", F.expr("~score").alias("down"), F.col("vec_id").alias("id"))).alias("held"))
    # suffix merges: from the last slot to the first, each the best of its own rows and of the merge after it
    merged = F.expr(f"""aggregate(reverse(sequence(1, size(limits))), CAST(array() AS array<array<struct<down:bigint,id:bigint>>>),
        (acc, s) -> concat(array(slice(array_sort(concat(transform(filter(held, h -> h.slot = s), h -> struct(h.down AS down, h.id AS id)),
            coalesce(try_element_at(acc, 1), CAST(array() AS array<struct<down:bigint,id:bigint>>)))), 1, {int(negatives)})), acc))""")
    windows = held.join(limits, "key").select("key", F.posexplode(merged).alias("nth", "best")).withColumn("nth", F.col("nth") + 1)
    wide = "decimal(20,0)"
    return (liked.join(windows, ["key", "nth"]).join(anchors.select("key", F.col("vec_id").alias("anchor_id")), "key")
            .select("anchor_id", "positive_id", "positive_score", F.posexplode("best").alias("rank", "n"))
            .select("anchor_id", "positive_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"), "positive_score", F.expr("~n.down").alias("negative_score"))
            .where(F.lit(low_percent) * F.col("positive_score").cast(wide) <= F.lit(100) * F.col("negative_score").cast(wide)))


#: DuckDB SQL of the registered query: all anchors against all rows.
ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.own
WHERE 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""
