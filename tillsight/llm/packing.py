"""Packing token sequences by cutting-stock column generation.

Documents become token ids (tokenizers) and an end id, written once. A document longer than ``LENGTH``
gives full sequences of its own; what is left over, 1 to ``LENGTH``-1 tokens, is packed with others:

* the lengths are counted in classes of ``GRAIN`` tokens, at most ``LENGTH / GRAIN`` numbers for any input;
* ``column_generation`` solves the cutting-stock linear program over them: a pattern says how many pieces
  of each class share a sequence; an unbounded-knapsack dynamic program prices new patterns with the duals
  until none improves by more than the gap; pattern counts are rounded down, and the few pieces left over are
  laid end to end and cut at the ends of sequences;
* documents are ranked within their class (a rank within their task, plus the counts of the tasks before),
  and ranks are dealt to the patterns' slots by an interval table, so a class that holds a third of all
  documents is never gathered.

Result: one row per piece. ``sequences`` joins the pieces to padded sequences.

Edge cases: null and empty texts are the end id alone; repeated rows and null ids are packed like any
other row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_batches, sized, written
from .tokens import encoder, portions

LENGTH, GRAIN = 2048, 8
#: A pattern used up to FEW times must be FULL; otherwise its pieces are laid end to end with the other leftovers.
FEW, FULL = 8, 0.99


# -- the linear program ----------------------------------------------------------------------------------

def price(sizes: np.ndarray, duals: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern with the largest sum of duals."""
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        value[c], fits = value[c - 1], np.searchsorted(sizes, c, side="right")
        if fits:
            worth = duals[:fits] + value[c - sizes[:fits]]
            k = int(worth.argmax())
            if worth[k] > value[c] + 1e-12:
                value[c], last[c] = worth[k], k
    pattern, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= sizes[last[c]]
    return float(value[capacity]), pattern


def enter(inverse: np.ndarray, step: np.ndarray, out: int) -> np.ndarray:
    """Inverse of the basis after a column with coordinates ``step`` has taken the place ``out``. Sums of products
    are written out here and below: small matrices gain nothing from a threaded BLAS beside a busy JVM."""
    row = inverse[out] / step[out]
    inverse = inverse - step[:, None] * row[None, :]
    inverse[out] = row
    return inverse


def first_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """One pattern for each class, its largest piece first and the room filled as far as it goes, used until a
    class runs out; the pattern takes that class's column, so the basis is triangular. With its inverse."""
    m, left = len(sizes), demand.copy()
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    while (left > 0).any():
        open_ = np.flatnonzero(left > 0)
        pattern = np.zeros(m)
        pattern[open_[-1]] = 1
        room = capacity - int(sizes[open_[-1]])
        if room >= sizes[open_[0]]:
            pattern[open_] += price(sizes[open_], sizes[open_].astype(float), room)[1]
        used = np.flatnonzero(pattern)
        out = used[int((left[used] / pattern[used]).argmin())]
        left[used] -= left[out] / pattern[out] * pattern[used]
        left[out] = 0
        basis[:, out], inverse = pattern, enter(inverse, (inverse * pattern).sum(axis=1), out)
    return basis, inverse


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 0.002, rounds: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, their amounts) of a basis within ``gap`` of the optimum, by Farley's bound or by the
    pieces' total size, or after ``rounds`` new patterns (few pieces need no better basis: what is not bulk is cut).
    A slight fixed perturbation of the demand keeps the simplex steps from stalling."""
    demand = demand * (1 + 1e-6 * np.random.default_rng(5).random(len(sizes)))
    basis, inverse = first_basis(sizes, demand, capacity)
    least = float((sizes * demand).sum()) / capacity
    for _ in range(rounds):
        amount = np.maximum((inverse * demand).sum(axis=1), 0)
        if amount.sum() <= (1 + gap) * least:
            break
        value, pattern = price(sizes, inverse.sum(axis=0), capacity)
        least = max(least, amount.sum() / value)
        if value <= 1 + gap:
            break
        step = (inverse * pattern).sum(axis=1)
        up = np.flatnonzero(step > 1e-9)
        out = up[int((amount[up] / step[up]).argmin())]
        basis[:, out], inverse = pattern, enter(inverse, step, out)
    return basis, np.maximum((inverse * demand).sum(axis=1), 0)


def patterns(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, dict[int, int]]], dict[int, int]]:
    """(times, {class: pieces}) in whole numbers, and the pieces of each class that rounding down left."""
    left = {c: n for c, n in counts.items() if n > 0}
    if not left:
        return [], {}
    sizes = np.array(sorted(left))
    columns, amount = column_generation(sizes, np.array([left[c] for c in sizes], float), capacity)
    out = []
    for k in np.argsort(-amount):
        held = {int(c): int(columns[i, k]) for i, c in enumerate(sizes) if columns[i, k] > 0}
        times = min([int(amount[k] + 1e-6), *(left[c] // n for c, n in held.items())])
        if times > FEW or times > 0 and sum(c * n for c, n in held.items()) >= FULL * capacity:
            out.append((times, held))
            for c, n in held.items():
                left[c] -= times * n
    return out, {c: n for c, n in left.items() if n}


def slots(found: list[tuple[int, dict[int, int]]], left: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Rows (class, first rank, rank after the last, pieces a sequence, first sequence, units before a cut), and the
    number of sequences. What rounding left, a few pieces for each pattern, is laid end to end and cut at the ends
    of sequences; the part after a cut goes to the next one."""
    out, rank, first = [], {}, 0
    for times, held in found:
        for c, n in held.items():
            lo = rank.get(c, 0)
            rank[c] = lo + times * n
            out.append((c, lo, rank[c], n, first, None))
        first += times
    room = capacity
    for c in sorted(left, reverse=True):
        for _ in range(left[c]):
            lo = rank.get(c, 0)
            rank[c] = lo + 1
            out.append((c, lo, lo + 1, 1, first, room if room < c else None))
            first, room = (first, room - c) if room > c else (first + 1, capacity - (c - room))
    return out, first + (room < capacity)


# -- Spark -----------------------------------------------------------------------------------------------

def tokenized(docs: DataFrame, path: str, units: str, end_id: int, length: int = LENGTH, grain: int = GRAIN) -> DataFrame:
    """Ids of every document, with its class and its ranks within the task that made it (a written table)."""
    schema = pa.schema([("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("part", pa.int32()),
                        ("cls", pa.int32()), ("rank", pa.int64()), ("full_before", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, end = encoder(path, units), TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        rank, full = [0] * (length // grain + 2), 0
        for whole in batches:
            for batch in portions(whole):
                rows = []
                for ids in e.encode_all(batch.column("text")):
                    ids += end
                    n = len(ids) // 4
                    c = -(-(n % length) // grain)
                    rows.append((n, ids, part, c, rank[c], full))
                    rank[c] += 1
                    full += n // length
                cols = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], schema=schema)

    return written(map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
        "doc_id long, doc_tokens long, ids binary, part int, cls int, rank long, full_before long"), "tokens")


def pack(docs: DataFrame, path: str, units: str = "blanks", end_id: int = 1, length: int = LENGTH, grain: int = GRAIN,
         with_ids: bool = True) -> DataFrame:
    """Pieces: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and their ids)."""
    spark = docs.sparkSession
    tokens = tokenized(docs, path, units, end_id, length, grain)
    counts = written(tokens.groupBy("part", "cls").agg(F.count("*").alias("n"), F.sum(F.floor(F.col("doc_tokens") / length)).alias("full")), "counts")
    classes = {r["cls"]: r["n"] for r in counts.groupBy("cls").agg(F.sum("n").alias("n")).collect()}  # length / grain rows at most
    rows, n_packed = slots(*patterns({c: n for c, n in classes.items() if c > 0}, length // grain), length // grain)

    before = Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = counts.groupBy("part").agg(F.sum("full").alias("full"))  # one row a task
    full_base = by_part.select("part", F.coalesce(
        F.sum("full").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("full_base"))
    base = written(counts.select("part", "cls", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).join(full_base, "part"), "bases")
    plan = spark.createDataFrame(rows, "cls int, lo long, hi long, per long, first long, cut long")

    d = tokens.join(sized(base), ["part", "cls"]).withColumn("_r", F.col("base") + F.col("rank"))
    # the interval table has a row for each class of each pattern, bounded by length / grain
    p = F.broadcast(plan.withColumnRenamed("cls", "_cls"))
    d = d.join(p, (F.col("cls") == F.col("_cls")) & (F.col("_r") >= F.col("lo")) & (F.col("_r") < F.col("hi")), "left")
    full = F.floor(F.col("doc_tokens") / length)

    def piece(start, size, sequence):
        ids = F.substring(F.col("ids"), (start * 4 + 1).cast("int"), (size * 4).cast("int"))
        values = [start.alias("start"), size.alias("length"), F.crc32(ids).alias("ids_crc32"), sequence.alias("sequence_id")]
        return F.struct(*values, *([ids.alias("ids")] if with_ids else []))

    whole = F.when(full > 0, F.transform(F.sequence(F.lit(0).cast("long"), full - 1), lambda k: piece(
        k * length, F.lit(length).cast("long"), F.lit(n_packed) + F.col("full_base") + F.col("full_before") + k)))
    size, cut = F.pmod("doc_tokens", F.lit(length).cast("long")), F.col("cut") * grain
    sequence = F.col("first") + F.floor((F.col("_r") - F.col("lo")) / F.col("per"))
    rest = F.when(F.col("cls") > 0, F.when(cut < size, F.array(
        piece(full * length, cut, sequence), piece(full * length + cut, size - cut, sequence + 1)))
        .otherwise(F.array(piece(full * length, size, sequence))))
    each = d.select("doc_id", "doc_tokens", F.explode(F.concat(F.coalesce(whole, F.array()), F.coalesce(rest, F.array()))).alias("p"))
    each = each.select("doc_id", "doc_tokens", "p.*")
    within = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)).cast("long"))


def padded_length(used, length: int = LENGTH):
    """A sequence is padded to ``length`` unless its tokens are a power of two."""
    return F.when(F.bit_count(used) == 1, used).otherwise(F.lit(length).cast("long"))


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """``sequence_id, ids`` (little-endian unsigned 32-bit), ``used`` and ``padded``: at most ``length`` tokens a group."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(ordered.alias("p"), F.sum("length").alias("used"))
    ids = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    padded = padded_length(F.col("used"), length)
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), (padded - F.col("used")).cast("int")))
    return joined.select("sequence_id", F.concat(ids, pad).alias("ids"), "used", padded.alias("padded"))
