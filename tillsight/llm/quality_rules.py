"""Quality rules learned as an ordered decision list (DataFrame functions only).

``text_stats`` gives every document its statistics with built-in expressions; ``learn_rules`` runs
sequential covering on the statistics of a bounded labelled sample: a rule is grown condition by condition
on two thirds of the rows (FOIL gain), pruned from its end on the last third, kept when it is precise
there, and the rows it covers leave. ``rule_column`` turns the ordered rules into one ``CASE WHEN``.

Edge cases: a null text counts as empty; an empty text has zero statistics and fails the base test; a
null or repeated ``doc_id`` passes through row by row; extra columns are ignored; without usable labels
the list is empty and only the base test decides. Texts of any length are read whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once, words_of

# Fixed values of the base contract.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3

#: Labelled documents the list is learned from at most (chosen by a hash of the id).
SAMPLE_ROWS = 8192
FEATURES = ["n_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate",
            "digit_rate", "mark_rate", "distinct_rate"]


def _repeat_words(hashes: Column) -> Column:
    """Words covered by three-word windows that occur twice or more: sort (hash, place), keep places whose
    hash equals a neighbour's, then add up the union of the windows."""
    places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def hit(s):
        return F.sort_array(F.transform(
            F.filter(s, lambda x, j: F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False))), lambda x: x["i"]))

    # one-element arrays bind a value once for the expression below them
    found = F.get(F.transform(F.array(places), hit), F.lit(0))

    def union(p):
        return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
                           F.lit(0), lambda a, x: a + x)

    return F.get(F.transform(F.array(found), union), F.lit(0))


def text_stats(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``doc_id`` (and the columns in ``keep``) with the statistics of the whole text."""
    cols = list(dict.fromkeys(["doc_id", *(keep or [])]))
    t = F.coalesce(F.col("text"), F.lit(""))
    d = once(docs.select(*cols, t.alias("_t")), [*cols, "_t"], {
        "_w": words_of(F.col("_t")), "_dense": F.translate("_t", SPACES, ""),
        "_lines": F.filter(F.split("_t", "\n"), lambda s: F.translate(s, SPACES, "") != "")})
    d = once(d, [*cols, "_t", "_w", "_lines", "_dense"], {"_h": F.when(
        F.size("_w") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_w") - WINDOW),
                    lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))})
    n = F.size("_w").cast("long")
    d = once(d, cols, {
        "n_words": n, "word_chars": F.length("_dense").cast("long"),
        "n_symbols": (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(F.size(F.array_distinct("_h")) == F.size("_h"), F.lit(0))
        .otherwise(_repeat_words(F.col("_h"))).cast("long"),
        "_n_lines": F.size("_lines"), "_n_distinct": F.size(F.array_distinct("_w")),
        "_n_upper": F.regexp_count("_t", F.lit(r"\p{Lu}")), "_n_digit": F.regexp_count("_t", F.lit("[0-9]")),
        "_n_mark": F.regexp_count("_t", F.lit("[!?]"))})
    per_word, per_char = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return d.select(
        *cols, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("word_chars") / per_word).alias("mean_word"), (F.col("n_symbols") / per_word).alias("symbol_rate"),
        (F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1))).alias("dup_line_rate"),
        (F.col("n_repeat_words") / per_word).alias("repeat_rate"), (F.col("_n_upper") / per_char).alias("upper_rate"),
        (F.col("_n_digit") / per_char).alias("digit_rate"), (F.col("_n_mark") / per_word).alias("mark_rate"),
        (F.col("_n_distinct") / per_word).alias("distinct_rate"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    op: str
    value: float

    def holds(self, row) -> bool:
        return row[self.feature] >= self.value if self.op == ">=" else row[self.feature] <= self.value

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.value) if self.op == ">=" else c <= F.lit(self.value)

    def __str__(self):
        return f"{self.feature} {self.op} {self.value:.6g}"


def _covered(rule, rows):
    return [r for r in rows if all(c.holds(r) for c in rule)]


def _cuts(values: list[float], most: int = 24) -> list[float]:
    """Midpoints between neighbouring quantiles, so that a threshold lies between seen values."""
    v = sorted(set(values))
    if len(v) > most:
        v = sorted({v[round(k * (len(v) - 1) / most)] for k in range(most + 1)})
    return [(a + b) / 2 for a, b in zip(v, v[1:])]


def _grow(bad, good, max_conditions):
    rule = []
    while good and len(rule) < max_conditions:
        p0, n0 = len(bad), len(good)
        before, best = math.log2(p0 / (p0 + n0)), (1e-9, None)
        for f in FEATURES:
            for cut in _cuts([r[f] for r in bad + good]):
                for op in (">=", "<="):
                    c = Condition(f, op, cut)
                    p = sum(1 for r in bad if c.holds(r))
                    if not p:
                        continue
                    gain = p * (math.log2(p / (p + sum(1 for r in good if c.holds(r)))) - before)
                    if gain > best[0]:
                        best = (gain, c)
        if best[1] is None:
            break
        rule.append(best[1])
        bad, good = _covered(rule[-1:], bad), _covered(rule[-1:], good)
    return rule


def _prune(rule, bad, good):
    """Shortest head of the rule with the best (p - n) / (p + n) on the pruning rows."""
    def worth(k):
        p, n = len(_covered(rule[:k], bad)), len(_covered(rule[:k], good))
        return ((p - n) / (p + n) if p + n else -1.0, -k)
    return rule[:-max(worth(k) for k in range(1, len(rule) + 1))[1]]


def cover(rows: list[dict], precision: float = 0.95, max_rules: int = 12, max_conditions: int = 4) -> list[list[Condition]]:
    """Ordered rules that reject: ``rows`` have the features, ``bad`` and ``fold`` (0 and 1 grow, 2 prunes)."""
    left, rules = rows, []
    while len(rules) < max_rules:
        bad, good = [r for r in left if r["bad"]], [r for r in left if not r["bad"]]
        grow_bad, grow_good = [r for r in bad if r["fold"] < 2], [r for r in good if r["fold"] < 2]
        if not grow_bad or not grow_good:
            break
        rule = _grow(grow_bad, grow_good, max_conditions)
        if not rule:
            break
        hold_bad, hold_good = [r for r in bad if r["fold"] == 2], [r for r in good if r["fold"] == 2]
        rule = _prune(rule, hold_bad, hold_good)
        p, n = len(_covered(rule, hold_bad)), len(_covered(rule, hold_good))
        if p < 3 or p < precision * (p + n):
            break
        rules.append(rule)
        left = [r for r in left if not all(c.holds(r) for c in rule)]
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Statistics of at most ``sample_rows`` labelled documents; conflicting labels of one id are left out."""
    y = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
         .agg(F.min("quality").alias("_lo"), F.max("quality").alias("_hi")).where("_lo = _hi")
         .select("doc_id", (F.col("_lo") == 0).alias("_bad"))
         .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    d = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id")  # at most sample_rows rows
    s = text_stats(d, keep=["_bad"]).where(~base_failed())
    got = s.select("doc_id", "_bad", *FEATURES).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).collect()
    return [{**{f: float(r[f]) for f in FEATURES}, "bad": bool(r["_bad"]), "fold": k % 3} for k, r in enumerate(got)]


def learn_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[list[Condition]]:
    return cover(labelled_sample(docs, labels, sample_rows))


def rule_column(rules: list[list[Condition]]) -> Column:
    """The first rule that holds, as text; null where none does."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        label = F.lit(" AND ".join(map(str, rule)))
        out = F.when(test, label) if out is None else out.when(test, label)
    return F.lit(None).cast("string") if out is None else out


def judge(docs: DataFrame, rules: list[list[Condition]], keep: list[str] | None = None) -> DataFrame:
    """Statistics, the base test, the first matching rule, and ``kept``."""
    s = text_stats(docs, keep).withColumn("base_failed", base_failed()).withColumn("rule", rule_column(rules))
    return s.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
