"""Risk levels, sales actions and risk scores for churn probabilities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight import constants as K
from tillsight.functions.columns import col


@dataclass(frozen=True)
class Thresholds:
    urgent: float = K.URGENT_THRESHOLD
    high: float = K.HIGH_THRESHOLD
    medium: float = K.MEDIUM_THRESHOLD

    @staticmethod
    def derived(urgent: float) -> "Thresholds":
        """Cut-offs below a tuned urgent threshold: high = max(.35, u-.2), medium = max(.2, high-.2)."""
        high = max(K.HIGH_THRESHOLD, urgent - 0.20)
        return Thresholds(urgent, high, max(K.MEDIUM_THRESHOLD, high - 0.20))


def thresholds_from_params(params: DataFrame) -> Thresholds:
    """Read thresholds from a (parameter_name, parameter_value) table.

    Values that are missing or do not parse fall back to the defaults. The
    table is a handful of configuration rows, fetched once.
    """
    names = {"UrgentThreshold": "urgent", "HighThreshold": "high", "MediumThreshold": "medium"}
    row = params.agg(*[F.max(F.when(F.col("parameter_name") == n,
                                    F.col("parameter_value").try_cast("double"))).alias(a)
                       for n, a in names.items()]).first()
    d = Thresholds()
    return Thresholds(*[row[a] if row[a] is not None else getattr(d, a) for a in names.values()])


def default_params(spark) -> DataFrame:
    """The default configuration table."""
    rows = [("LookbackDays", str(K.LOOKBACK_DAYS)), ("UrgentThreshold", repr(K.URGENT_THRESHOLD)),
            ("HighThreshold", "0.35"), ("MediumThreshold", "0.20"),
            ("ActiveModelName", K.ACTIVE_MODEL_NAME), ("ActiveModelVersion", K.ACTIVE_MODEL_VERSION)]
    return spark.createDataFrame(rows, "parameter_name string, parameter_value string")


def risk_level(prob: Column | str, t: Thresholds) -> Column:
    p = col(prob)
    return (F.when(p >= F.lit(t.urgent), K.LEVEL_URGENT)
             .when(p >= F.lit(t.high), K.LEVEL_HIGH)
             .when(p >= F.lit(t.medium), K.LEVEL_MEDIUM)
             .otherwise(K.LEVEL_LOW))


def sales_action(level: Column | str, segment: Column | str, recency: Column | str,
                 vip_segment: str = K.VIP_SEGMENT) -> Column:
    """First matching rule wins; a null recency never satisfies ``> n``."""
    lv, seg, rec = col(level), col(segment), col(recency)
    urgent = lv == F.lit(K.LEVEL_URGENT)
    return (F.when(urgent & (seg == F.lit(vip_segment)), K.ACTION_VISIT)
             .when(urgent | (rec > K.RECENCY_CALL_DAYS), K.ACTION_CALL)
             .when((lv == F.lit(K.LEVEL_HIGH)) | (rec > K.RECENCY_OFFER_DAYS), K.ACTION_OFFER)
             .otherwise(K.ACTION_FOLLOW_UP))


def risk_score(prob: Column | str, clip: bool = True) -> Column:
    """prob x 10; clipped to [1, 10] and rounded to 1 decimal (half-even) when ``clip``."""
    s = col(prob).cast("double") * 10
    return F.bround(F.least(F.greatest(s, F.lit(1.0)), F.lit(10.0)), 1) if clip else s


def apply_rules(scores: DataFrame, snapshot: DataFrame | None, t: Thresholds,
                vip_segment: str = K.VIP_SEGMENT, clip_score: bool = False) -> DataFrame:
    """Score rows (snapshot_date, customer_name, churn_prob[, risk_score]) -> level, action.

    Features come from a left join to the snapshot on (snapshot_date,
    customer_name): a score without a snapshot row keeps null segment and
    recency and falls through to the later rules.
    """
    s = scores
    if snapshot is not None:
        feats = snapshot.select("snapshot_date", "customer_name", "segment", "recency")
        s = s.drop(*[c for c in ("segment", "recency") if c in s.columns]) \
             .join(feats, ["snapshot_date", "customer_name"], "left")
    fill = risk_score("churn_prob", clip=clip_score)
    rs = F.coalesce(F.col("risk_score").cast("double"), fill) if "risk_score" in s.columns else fill
    lvl = risk_level("churn_prob", t)
    return (s.withColumn("risk_score", rs)
             .withColumn("risk_level", lvl)
             .withColumn("sales_action", sales_action(lvl, "segment", "recency", vip_segment)))
