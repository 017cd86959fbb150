"""All checks of a written table in one aggregate: one scan of the columns they name, instead of one a check.

Row count, money sums, nulls of the columns that may hold none, and values out of range. (Spark's ``Observation`` would
measure them during the write, but once a session has observed, closures that hold the session, as those of
``pyspark.ml`` models do, can no longer be sent to executors; so the table is read again, once.) An empty table has 0
rows, no sums and no nulls.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(RuntimeError):
    """A written table breaks its contract."""


@dataclass
class Checks:
    name: str
    not_null: Sequence[str] = ()
    sums: Sequence[str] = ()
    wrong: Mapping[str, Column] = field(default_factory=dict)

    def measure(self, df: DataFrame) -> DataFrame:
        """One row of figures."""
        return df.agg(F.count(F.lit(1)).alias("row_count"),
                      *[F.sum(c).cast("double").alias(f"sum_{c}") for c in self.sums],
                      *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.not_null],
                      *[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"wrong_{k}") for k, bad in self.wrong.items()])

    def require(self, df: DataFrame) -> dict:
        """The figures, or ``CheckFailed`` where a column that may hold no null holds one or a value is out of range."""
        m = self.measure(df).first().asDict()
        bad = {k: v for k, v in m.items() if k.startswith(("null_", "wrong_")) and v}
        if bad:
            raise CheckFailed(f"{self.name}: {bad}")
        return m

    def report(self, df: DataFrame) -> DataFrame:
        """``table_name, metric, value``."""
        one = self.measure(df)
        pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in one.columns])
        return one.select(F.lit(self.name).alias("table_name"), F.inline(pairs))
