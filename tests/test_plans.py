"""Plan shapes: the properties the design relies on, read from explain()."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as E
from wattgrid.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
# Run jobs of their own (a fit) before there is a plan.
ML = {"forecast_gbt", "forecast_metrics", "importance_topn", "forecast_trees", "forecast_predictions", "boost_histogram",
      "round_metrics", "household_job"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchanges(text):
    return re.findall(r"Arguments: (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition)", text)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ML))
def test_no_pairs_are_ever_formed(spark, name):
    text = plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_bin_means_are_two_exchanges_after_partial_aggregates(spark):
    text = plan(E.queries()["resample_mean"](spark, SF))
    keys = [re.sub(r"#\d+L?", "", e) for e in exchanges(text)]
    # first reading per time, then bin means
    assert len(keys) == 2
    assert keys[0].startswith("hashpartitioning(home_id, ts,")
    assert keys[1].startswith("hashpartitioning(home_id, _bin,")
    assert re.search(r"HashAggregate[\s\S]*partial_avg", text)
    assert "PushedFilters: [In(event_type" in text or "In(event_type," in text


def test_feature_chain_deals_no_rows_by_home_alone_and_has_no_python(spark):
    text = plan(E.queries()["feature_matrix"](spark, SF))
    keys = [re.sub(r"#\d+L?", "", e) for e in exchanges(text)]
    assert keys and not any(k.startswith("hashpartitioning(home_id") for k in keys)
    assert any(k.startswith("hashpartitioning(_key, _block,") for k in keys)
    assert not re.search(r"MapInPandas|FlatMapGroupsInPandas|EvalPython|MapInArrow", text)


def test_asof_forms_no_pairs_and_pushes_its_filter(spark):
    text = plan(E.queries()["asof_nearest"](spark, SF))
    keys = [re.sub(r"#\d+L?", "", e) for e in exchanges(text)]
    # Rows are dealt by piece, and by (key, time) to make times distinct.
    assert any(k.startswith("hashpartitioning(_key, _b, _p, _salt,") for k in keys)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "EqualTo(event_type,click)" in text


def test_python_only_in_the_schedule_flow(spark):
    for name in sorted(set(QUERIES) - ML):
        text = plan(E.queries()[name](spark, SF))
        assert not re.search(r"BatchEvalPython|ArrowEvalPython", text), name
