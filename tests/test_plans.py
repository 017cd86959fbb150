"""Physical-plan guards: the shapes the scale design depends on."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tillsight.plans import model_queries as MQ


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(MQ.registry())))
def test_no_cross_or_nested_loop_joins(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_feature_snapshot_plan(spark):
    p = plan(E.queries()["q_multi_snapshot"](spark, SF_SMALL))
    # the date window reaches the lineitem scan
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", p)
    # one hash exchange: the (snapshot, customer) aggregate; the calendar is broadcast
    assert len(re.findall(r"hashpartitioning\(", p)) == 1
    assert "BroadcastHashJoin" in p
    # only the needed lineitem columns are read
    scan = re.search(r"Location: InMemoryFileIndex \[[^\]]*lineitem.parquet\]\n.*\nReadSchema: (struct<[^>]*>)", p)
    assert scan and "l_tax" not in scan.group(1) and "l_comment" not in scan.group(1)
