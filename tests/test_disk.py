"""What jobs leave on disk: shuffles end with their job, tables are written once, rows are shuffled whole only where they must be."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_scale import lines, plan
from tillsight.operators import daystates as DS
from tillsight.operators import features
from tillsight.operators import warehouse as WH
from tillsight.plans import fixtures as FX
from tillsight.plans import pipeline as PL
from tillsight.plans import published as PB
from tillsight.plans import queries as Q
from tillsight.session import DROP_SHUFFLES, materialize
from test_pipeline_safety import sale


def shuffle_files(spark) -> set:
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle(spark):
    """F1 to F10."""
    before, kept = shuffle_files(spark), spark.conf.get(DROP_SHUFFLES, None)
    got = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "count"))
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and got.count() == 7 and spark.conf.get(DROP_SHUFFLES, None) == kept


def versions(spark):
    rows = [(k, None if k in (None, "n") else k * 2, n, b) for n, k in enumerate(["a", "b", "c", "d", None, "n", None, "a"]) for b in ("x", "y")[: 1 + n // 4]]
    return spark.createDataFrame([(r[0], r[1], i, r[3]) for i, r in enumerate(rows)], "key string, other string, at int, batch string")


@pytest.mark.parametrize("marks", [{}, {"MARK_BITS": 4, "MARK_ROW_BITS": 3}, {"MAX_MARKED": 0}])
def test_newest_rows_of_a_stored_table(spark, monkeypatch, marks):
    """F1, F2, F4, F5, F7, F8: as newest_per_key, with rows that share a mark, null keys and too many repeated keys."""
    for k, v in marks.items():
        monkeypatch.setattr(WH, k, v)
    df = materialize(versions(spark).select("other", "key", "at", "batch"))
    for keys in (["key"], ["key", "other"], ["at"]):
        got, want = WH.newest_of_stored(df, keys, ["at"]), WH.newest_per_key(df, keys, ["at"])
        assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_single_keys_are_not_grouped_whole(spark):
    """F1, F2, F4, F5, F7, F8."""
    df = materialize(spark.range(100).withColumn("v", F.lit("x")))
    text = plan(WH.newest_of_stored(df, ["id"], ["v"]))
    assert "Exchange" not in text and "Aggregate" not in text


def test_a_rewrite_is_written_once(spark, tmp_path):
    """only the folders of new content change, nothing else is left beside them."""
    base, cols = str(tmp_path), "day date, name string, version string, v int"
    day, other = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    parts = ["day", "name", "version"]
    PL.replace(spark.createDataFrame([(day, "a/b", "1.0", 1), (day, "c", "01", 2), (other, "c", "01", 3)], cols), base, "t", parts, ["v"])
    got = PL.replace(spark.createDataFrame([(day, "a/b", "1.0", 4), (day, "a/b", "1.0", 5), (None, "c", None, 6)], cols), base, "t", parts)
    assert got.dtypes == [("day", "date"), ("name", "string"), ("version", "string"), ("v", "int")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(day, "a/b", "1.0", 4), (day, "a/b", "1.0", 5), (None, "c", None, 6)], key=repr)
    assert sorted(r[0] for r in spark.read.parquet(f"{base}/t").select("v").collect()) == [2, 3, 4, 5, 6]
    assert PL.replace(got.limit(0), base, "t", parts).collect() == [] and spark.read.parquet(f"{base}/t").count() == 5
    PL.replace(got, base, "u")
    assert [r[0] for r in PL.replace(spark.read.parquet(f"{base}/u").groupBy().agg(F.sum("v").alias("v")), base, "u").collect()] == [15]
    left = [f for d, _, names in os.walk(base) for f in names if f.endswith(".parquet") and "/_new" in d]
    assert not left and not any("/tables/" in f for f in got.inputFiles())


def test_the_fact_of_a_load_is_made_once(spark, tmp_path, monkeypatch):
    """months, moved rows, days and the upsert read rows that were made once."""
    seen, upsert = [], WH.upsert
    monkeypatch.setattr(PB.WH, "upsert", lambda target, source, *a, **k: seen.append(source) or upsert(target, source, *a, **k))
    w = PB.Warehouse(spark, str(tmp_path))
    PB.load_batch(w, sale(spark, ("1", "05/09/2023", "c", 5), ("1", "05/09/2023", "c", 5), ("2", "06/09/2023", "d", 7)), "b1", "f", {})
    PB.load_batch(w, sale(spark, ("1", "05/10/2023", "c", 6)), "b2", "f", {})
    facts = [s for s in seen if "source_row_id" in s.columns]
    assert len(facts) == 1 and all("/tables/fact_new-" in f for f in facts[0].inputFiles())
    assert sorted(map(tuple, w.table("fact_sales").select("source_row_id", "date_key").collect())) == [("1", 20231005), ("2", 20230906)]
    assert sorted(map(tuple, w.table("customer_days").select("customer_name", "lines", F.dayofmonth("sale_date"), F.month("sale_date")).collect())) == [
        ("c", 1, 5, 10), ("d", 1, 6, 9)]


def test_labels_come_with_the_features(spark):
    """one shuffle of the lines for both, with the rows that two would give."""
    s, snaps = lines(spark), features.month_ends("2019-06-30", "2023-06-30")
    wins = {snaps[3]: (dt.date(2020, 1, 1), dt.date(2020, 12, 31)), snaps[9]: (dt.date(2019, 1, 2), dt.date(2019, 1, 1))}
    for w in (None, wins):
        got, want = features.labeled_features(s, snaps, 90, w), features.with_churn_label(features.customer_features(s, snaps, 90), s, snaps, w)
        assert got.columns == want.columns and {0, 1} == {r["churn_label"] for r in got.collect()}
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        assert plan(features.labeled_features(s, snaps, 90, w)).count("hashpartitioning(") == 1


def test_a_day_state_shuffles_the_last_id_once(spark):
    """F6."""
    assert "max_by" not in plan(DS.day_states(lines(spark)))


def test_staging_is_a_written_table(spark):
    """F5, F7, F8, F9: staged rows are no cached blocks that spill uncompressed."""
    for st in (FX.staged_table(spark, SF_SMALL), FX.load_table(spark, SF_SMALL, ["revenue"])):
        assert all("/tables/staging-" in f for f in st.inputFiles())
    files = Q.q_fact_sales(spark, SF_SMALL).inputFiles()
    assert files and not any("lineitem" in f for f in files)
