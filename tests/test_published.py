"""Loads are published whole or not at all; day states give the features of sale lines."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_pipeline_safety import sale
from tillsight.operators import daystates as DS
from tillsight.operators import features as FE
from tillsight.plans import published as PB


def rows_of(warehouse):
    fact = warehouse.table("fact_sales")
    return sorted((r["source_row_id"], r["load_batch_id"], int(r["revenue"]), r["sale_month"]) for r in fact.collect())


@pytest.fixture
def warehouse(spark):
    w = PB.Warehouse(spark, tempfile.mkdtemp())
    PB.load_batch(w, sale(spark, ("1", "05/09/2023", "c", 5), ("2", "06/10/2023", "d", 7), ("3", "no date", "d", 7)), "b 1/x:y", "f1", {})
    return w


STEPS = ["staging", "dim_date", "dim_customer", "dim_product", "fact_sales", "customer_days", "publish"]


@pytest.mark.parametrize("at", STEPS)
def test_a_load_that_stops_changes_nothing(spark, warehouse, at):
    before, tables = rows_of(warehouse), {n: warehouse.table(n).count() for n in warehouse.manifest()["tables"]}

    def step(name):
        if name == at:
            raise KeyboardInterrupt(name)

    again = sale(spark, ("1", "05/09/2023", "c", 50), ("9", "07/11/2023", "e", 9))
    with pytest.raises(KeyboardInterrupt):
        PB.load_batch(warehouse, again, "b2", "f2", {}, step)
    other = PB.Warehouse(spark, warehouse.home)
    assert rows_of(other) == before and {n: other.table(n).count() for n in tables} == tables and other.versions() == [1]
    status = {r["load_batch_id"]: r for r in other.ledger().collect()}
    assert status["b 1/x:y"]["status"] == "SUCCESS" and status["b 1/x:y"]["rows_rejected"] == 1 and status["b 1/x:y"]["version"] == 1
    assert status["b2"]["status"] == "FAILED" and status["b2"]["finished_at"] is not None and at in status["b2"]["error"]
    if at == STEPS[-1]:
        PB.load_batch(other, again, "b2", "f2", {})
        assert rows_of(other) == [("1", "b2", 50, 202309), ("2", "b 1/x:y", 7, 202310), ("9", "b2", 9, 202311)]
        assert rows_of(warehouse) == rows_of(other) and [r[:3] for r in before] == [(r["source_row_id"], r["load_batch_id"], int(r["revenue"])) for r in
                                                                                    sorted(warehouse.table("fact_sales", manifest=warehouse.manifest(1)).collect(), key=lambda r: r["source_row_id"])]
        assert len(other.vacuum(keep=1)) == 1 and rows_of(other)[0] == ("1", "b2", 50, 202309)


def test_a_lost_driver_leaves_the_old_version_and_an_open_row(spark, warehouse):
    lost = warehouse.load("b2", "f2").__enter__()      # the driver ends here: no further event
    lost.write(warehouse.table("fact_sales").limit(0), "fact_sales", "sale_month", (), ["202309"])
    other = PB.Warehouse(spark, warehouse.home)
    assert len(rows_of(other)) == 2
    assert {r["status"] for r in other.ledger().where("load_batch_id = 'b2'").collect()} == {"STARTED"}
    assert len(other.recover()) == 1 and other.recover() == []
    assert {r["status"] for r in other.ledger().where("load_batch_id = 'b2'").collect()} == {"FAILED"}


def test_two_loads_from_one_version_cannot_both_publish(spark, warehouse):
    one, two = warehouse.load("b2"), warehouse.load("b3")
    one.__enter__(), two.__enter__()
    one.__exit__(None, None, None)
    with pytest.raises(PB.Conflict):
        two.__exit__(None, None, None)
    assert warehouse.versions() == [1, 2]
    assert {r["load_batch_id"]: r["status"] for r in warehouse.ledger().collect()} == {"b 1/x:y": "SUCCESS", "b2": "SUCCESS", "b3": "FAILED"}


def test_a_moved_row_leaves_its_old_month_and_day(spark, warehouse):
    PB.load_batch(warehouse, sale(spark, ("1", "05/12/2023", "c", 6)), "b2", "f2", {})
    assert rows_of(warehouse) == [("1", "b2", 6, 202312), ("2", "b 1/x:y", 7, 202310)]
    days = warehouse.table("customer_days")
    assert sorted((r["customer_name"], str(r["sale_date"]), int(r["revenue"])) for r in days.collect()) == [("c", "2023-12-05", 6), ("d", "2023-10-06", 7)]
    # the day states of the warehouse are those of its fact
    lines = DS.lines_of(warehouse.table("fact_sales"), warehouse.table("dim_date"), warehouse.table("dim_customer"))
    assert sorted(map(str, DS.day_states(lines).collect())) == sorted(map(str, days.drop("sale_month").collect()))


def test_states_give_the_features_of_lines(spark):
    from tillsight.plans import fixtures as FX
    from tillsight.plans import params as P
    sales = FX.sales(spark, SF_SMALL)
    odd = sales.limit(40).withColumn("customer_name", F.lit("hot")).withColumn("promo_pct", F.lit(None).cast("decimal(18,8)"))
    sales = sales.unionByName(odd).unionByName(sales.limit(3).withColumn("customer_name", F.lit(None).cast("string"))).unionByName(sales.limit(3).withColumn("sale_date", F.lit(None).cast("date")))
    for lookback in (1, 90, 400):
        want = FE.customer_features(sales, P.SNAPSHOTS, lookback)
        got = DS.features_from_states(DS.day_states(sales), P.SNAPSHOTS, lookback)
        assert got.columns == want.columns
        assert sorted(map(str, got.drop("segment").collect())) == sorted(map(str, want.drop("segment").collect()))
    assert DS.day_states(sales.limit(0)).count() == 0


def test_refreshed_redoes_only_the_days_asked(spark):
    from tillsight.plans import fixtures as FX
    sales = FX.sales(spark, SF_SMALL)
    late = sales.where(F.col("sale_date") == "1998-07-01")
    states = DS.refreshed(DS.day_states(sales.where("sale_date <> date'1998-07-01'")), late, sales)
    assert sorted(map(str, states.collect())) == sorted(map(str, DS.day_states(sales).collect()))
