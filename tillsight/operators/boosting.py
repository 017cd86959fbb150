"""Second-order gradient-boosted trees with L1 and L2 leaf penalties, one histogram aggregate a tree level.

Features are cut into at most ``bins`` quantile bins; a level sums gradients and hessians by (node, feature, bin) in one
``groupBy``, with partial sums in each task (numpy on Arrow batches, so a row is neither copied for each feature nor is new
code generated for each tree). Only those sums, nodes x features x bins rows, reach the driver, which picks
the best cut of every node. Gradients are summed as fixed-point integers, so a model does not depend on partitioning,
task order or retries. Rows are drawn for each tree by a checksum of their key, columns by one of their name.

Null, infinite and NaN features count as 0; rows without a label or key are not trained on. Rows sharing a key are drawn together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.operators.logistic import probability
from tillsight.session import materialize

#: Fixed-point unit of gradient sums: exact for over 10^11 rows.
UNIT = 2**26
#: Draws compare the first 7 hex digits of a checksum.
DRAW = 16**7
#: Gains at or under it make no split.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Params:
    rounds: int = 120
    depth: int = 2
    rate: float = 0.05
    rows: float = 0.9
    columns: float = 0.9
    min_weight: float = 2.0
    l2: float = 3.0
    l1: float = 0.2
    bins: int = 32
    seed: int = 42
    #: Rounds whose trees are added to the margin in one plan before it is written.
    stride: int = 10


@dataclass
class Node:
    round: int
    node: int
    weight: float
    feature: int = -1
    bin: int = -1
    cut: float = 0.0
    gain: float = 0.0
    value: float = 0.0


@dataclass
class Trees:
    names: list[str]
    params: Params
    nodes: list[Node] = field(default_factory=list)

    def margin(self) -> Column:
        """Sum of leaf values for the feature array ``x``; the trees are one literal array, walked level by level."""
        size = 2 ** (self.params.depth + 1) - 1
        rounds = sorted({n.round for n in self.nodes})
        if not rounds:
            return F.lit(0.0)
        trees = {r: [Node(r, k + 1, 0.0) for k in range(size)] for r in rounds}
        for n in self.nodes:
            trees[n.round][n.node - 1] = n
        text = ",".join("named_struct('f',array(%s),'c',array(%s),'v',array(%s))" % (
            ",".join(str(n.feature) for n in t), ",".join(f"{n.cut!r}D" for n in t), ",".join(f"{n.value!r}D" for n in t)) for t in trees.values())
        walk = (f"aggregate(sequence(1, {self.params.depth}), 1, (n, i) -> "
                "if(t.f[n - 1] < 0, n, if(x[t.f[n - 1]] <= t.c[n - 1], 2 * n, 2 * n + 1)))")
        return F.expr(f"aggregate(array({text}), named_struct('x', x, 'm', 0D), (a, t) -> named_struct('x', a.x, 'm', a.m + "
                       f"t.v[{walk.replace('x[', 'a.x[')} - 1]), a -> a.m)")

    def transform(self, df: DataFrame, features: Sequence[Column], out: str = "churn_prob") -> DataFrame:
        """``df`` with the probability; ``features`` in the order of ``names``."""
        whole = df.select(F.struct(*df.columns).alias("_row"), F.array(*[clean(c) for c in features]).alias("x"))
        return whole.select("_row", probability(self.margin()).alias("_p")).select("_row.*", F.col("_p").alias(out))


def clean(c: Column) -> Column:
    x = c.cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)


def drawn_columns(names: Sequence[str], round_: int, p: Params) -> list[int]:
    """The tree's columns: those with the least checksums of seed, round and name."""
    n = max(1, int(p.columns * len(names)))
    order = sorted(range(len(names)), key=lambda k: (hashlib.md5(f"{p.seed}:{round_}:{names[k]}".encode()).hexdigest(), k))
    return sorted(order[:n])


def drawn_row(key: Column, round_: int, p: Params) -> Column:
    sign = F.conv(F.substring(F.md5(F.concat(F.lit(f"{p.seed}:{round_}:"), key)), 1, 7), 16, 10).cast("long")
    return sign < int(p.rows * DRAW)


def shrunk(g: float, l1: float) -> float:
    return g - l1 if g > l1 else g + l1 if g < -l1 else 0.0


def score(g: float, h: float, p: Params) -> float:
    return shrunk(g, p.l1) * shrunk(g, p.l1) / (h + p.l2)


def leaf(g: float, h: float, p: Params) -> float:
    return -p.rate * shrunk(g, p.l1) / (h + p.l2) + 0.0  # no negative zero


def best_split(hist: dict[int, dict[int, tuple[int, int]]], cuts: list[list[float]], p: Params) -> tuple | None:
    """(gain, feature, bin, left sums, right sums) of a node; ``hist``: feature -> bin -> integer sums. Ties: least feature, least bin."""
    best = None
    for f in sorted(hist):
        bins = hist[f]
        G, H = sum(g for g, _ in bins.values()), sum(h for _, h in bins.values())
        gl = hl = 0
        for b in range(len(cuts[f])):
            g, h = bins.get(b, (0, 0))
            gl, hl = gl + g, hl + h
            a, c, d, e = gl / UNIT, hl / UNIT, (G - gl) / UNIT, (H - hl) / UNIT
            if c < p.min_weight or e < p.min_weight:
                continue
            gain = score(a, c, p) + score(d, e, p) - score(G / UNIT, H / UNIT, p)
            if gain > LEAST_GAIN and (best is None or gain > best[0]):
                best = (gain, f, b, (gl, hl), (G - gl, H - hl))
    return best


def quantile_cuts(df: DataFrame, n: int, bins: int) -> list[list[float]]:
    """Distinct quantiles of every feature of array ``x``: one aggregate, ``n`` x ``bins`` numbers."""
    probs = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col("x")[k], probs, 100_000).alias(f"c{k}") for k in range(n)]).first()
    return [sorted(set(row[k] or [])) for k in range(n)]


def reached(b: np.ndarray, nodes: dict[int, Node]) -> np.ndarray:
    """The node that every row of bins has reached."""
    at = np.ones(len(b), np.int64)
    for k in sorted(nodes):  # parents first
        if nodes[k].feature >= 0:
            here = at == k
            at[here] = np.where(b[here, nodes[k].feature] <= nodes[k].bin, 2 * k, 2 * k + 1)
    return at


def partial_hists(trees: Sequence[dict[int, Node]], nodes: dict[int, Node], live: Sequence[int], use: Sequence[int], bins: int) -> Callable:
    """A task's gradient and hessian sums by (node, feature, bin) of rows ``y, m, b``, whose margin still lacks ``trees``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(live), len(use), bins), np.int64)
        seen = np.zeros((len(live), len(use), bins), bool)
        slot = np.full(max(live) + 2, -1)
        slot[list(live)] = np.arange(len(live))
        for batch in batches:
            y, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "m"))
            if not len(y):
                continue
            b = batch.column("b").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            for tree in trees:
                leaves = np.zeros(max(tree) + 1)
                for k, n in tree.items():
                    leaves[k] = n.value
                m = m + leaves[reached(b, tree)]
            prob = 1.0 / (1.0 + np.exp(-np.clip(m, -700.0, 700.0)))
            at = reached(b, nodes)
            at = np.where(at < len(slot), slot[np.minimum(at, len(slot) - 1)], -1)
            asked = at >= 0
            # a batch's sums of 26-bit numbers are exact as doubles
            g = np.floor((prob - y) * UNIT + 0.5)[asked]
            h = np.floor(prob * (1.0 - prob) * UNIT + 0.5)[asked]
            at, b = at[asked], b[asked]
            for j, f in enumerate(use):
                cell = at * bins + b[:, f]
                for i, v in enumerate((g, h)):
                    sums[i, :, j] += np.bincount(cell, v, len(live) * bins).astype(np.int64).reshape(len(live), bins)
                seen[:, j] |= np.bincount(cell, minlength=len(live) * bins).reshape(len(live), bins) > 0
        node, j, v = np.nonzero(seen)
        yield pa.record_batch([pa.array(np.array(live, np.int32)[node]), pa.array(np.array(use, np.int32)[j]), pa.array(v.astype(np.int32)),
                               pa.array(sums[0][seen]), pa.array(sums[1][seen])], names=["node", "f", "v", "g", "h"])
    return run


def fit(df: DataFrame, features: Sequence[Column], names: Sequence[str], label: Column, key: Column, params: Params = Params()) -> Trees:
    """Train on 0/1 labels; ``key`` is a text that names a row."""
    p, n = params, len(names)
    rows = materialize(df.select(key.cast("string").alias("k"), label.cast("double").alias("y"), F.array(*[clean(c) for c in features]).alias("x"))
                       .where("k IS NOT NULL AND y IS NOT NULL"), "boost_rows")
    cuts = quantile_cuts(rows, n, p.bins)
    found = F.array(*[sum([(F.col("x")[k] > c).cast("int") for c in cuts[k]], F.lit(0)) for k in range(n)])
    rows = materialize(rows.select("k", "y", found.alias("b"), F.lit(0.0).alias("m")), "boost_bins")
    model, fresh = Trees(list(names), p), []
    most = max((len(c) for c in cuts), default=0) + 1
    for t in range(1, p.rounds + 1):
        use = drawn_columns(names, t, p)
        drawn = rows.where(drawn_row(F.col("k"), t, p)).select("y", "m", "b")
        nodes: dict[int, Node] = {}
        live = [1]
        for level in range(p.depth):
            parts = drawn.mapInArrow(partial_hists(fresh, nodes, live, use, most), "node int, f int, v int, g long, h long")
            sums = parts.groupBy("node", "f", "v").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            hists: dict[int, dict] = {k: {} for k in live}
            for r in sums:
                hists[r["node"]].setdefault(r["f"], {})[r["v"]] = (r["g"], r["h"])
            nxt = []
            for k in live:
                some = next(iter(hists[k].values()), {})
                G, H = sum(g for g, _ in some.values()), sum(h for _, h in some.values())
                nodes[k] = Node(t, k, H / UNIT, value=leaf(G / UNIT, H / UNIT, p))
                s = best_split(hists[k], cuts, p)
                if s is None:
                    continue
                nodes[k] = Node(t, k, H / UNIT, s[1], s[2], cuts[s[1]][s[2]], s[0])
                for child, (g, h) in ((2 * k, s[3]), (2 * k + 1, s[4])):
                    nodes[child] = Node(t, child, h / UNIT, value=leaf(g / UNIT, h / UNIT, p))
                    nxt.append(child)
            live = nxt
            if not live:
                break
        model.nodes += [nodes[k] for k in sorted(nodes)]
        fresh.append(nodes)
        if t % p.stride == 0 and t < p.rounds:
            for tree in fresh:
                rows = rows.withColumn("m", F.col("m") + value(F.col("b"), tree))
            rows, fresh = materialize(rows, "boost_margin"), []
    return model


def value(b: Column, nodes: dict[int, Node], k: int = 1) -> Column:
    if nodes[k].feature < 0:
        return F.lit(nodes[k].value)
    return F.when(b[nodes[k].feature] <= nodes[k].bin, value(b, nodes, 2 * k)).otherwise(value(b, nodes, 2 * k + 1))


def report(model: Trees, df: DataFrame) -> DataFrame:
    """The trees as rows: ``round, node, feature, cut, gain, weight, value`` (leaves have no feature, cut or gain)."""
    rows = [(n.round, n.node, model.names[n.feature] if n.feature >= 0 else None, n.cut if n.feature >= 0 else None,
             n.gain if n.feature >= 0 else None, n.weight, None if n.feature >= 0 else n.value) for n in model.nodes]
    return df.sparkSession.createDataFrame(rows, "round int, node int, feature string, cut double, gain double, weight double, value double")
