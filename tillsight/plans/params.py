"""Test-data parameters shared by the registered queries and their SQL oracle."""

from __future__ import annotations

import datetime as dt

from tillsight.operators.features import month_ends

TRAIN_SNAPSHOT = dt.date(1998, 6, 30)
TEST_SNAPSHOT = dt.date(1998, 7, 31)
FORECAST_SNAPSHOT = dt.date(1998, 8, 31)
SNAPSHOTS = (TRAIN_SNAPSHOT, TEST_SNAPSHOT, FORECAST_SNAPSHOT)
LOOKBACK = 90

# Every month end the test tables cover (ship dates run 1995-01 .. 2001-11).
ALL_MONTH_ENDS = tuple(month_ends("1995-01-01", "2001-12-31"))

# Category map for the test tables' product codes (leading letters of
# part type + size); SMALL and LARGE are left unmapped on purpose.
TEST_CATEGORY_MAP = {"STANDARD": "core", "PROMO": "promotion", "ECONOMY": "core", "MEDIUM": "mid"}

# Segments of the test tables (order priorities), and rounds of the boosted model that SQL trains too.
SEGMENTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
BOOST_ROUNDS = 3

# VIP segment of the test tables (order priority plays the segment).
TEST_VIP_SEGMENT = "1-URGENT"

# Batch split of the test tables.
BATCH_CUT = "1998-07-01"
RELOAD_FROM = dt.date(1998, 6, 1)


def pseudo_prob_sql(recency: str = "recency", frequency: str = "frequency") -> str:
    """Deterministic stand-in for a model score, identical in Spark and DuckDB.

    Integer arithmetic over bigints divided by 128, so every value is a
    dyadic rational: sums over any number of rows are exact doubles and
    every aggregate of it is order independent.
    """
    return (f"cast((cast({recency} as bigint) * 37 + cast({frequency} as bigint) * 11) % 128 "
            f"as double) / 128.0")
