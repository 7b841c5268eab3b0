"""Physical plans: no Python, few exchanges, pruned scans, no unbounded tasks."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from fareflow.operators import enrich, labels, windows
from fareflow.plans.checks import ORACLE, QUERIES, registry

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")


def plan(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def test_package_has_no_python_functions_in_plans():
    root = os.path.join(os.path.dirname(os.path.dirname(__file__)), "fareflow")
    sources = glob.glob(os.path.join(root, "**", "*.py"), recursive=True)
    text = "\n".join(open(p).read() for p in sources if not p.startswith(os.path.join(root, "llm")))
    for word in ("pandas_udf", "F.udf", "applyInPandas", "mapInPandas", ".rdd", "localCheckpoint", "crossJoin", "toPandas"):
        assert word not in text, word


@needs_data
def test_label_is_one_exchange(spark, capsys):
    t = registry.Tables(spark, DATA)
    text = plan(labels.trend(registry.history(t), registry.HISTORY_KEYS, registry.HISTORY_ORDER), capsys, "simple")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"\+- Sort ", text)) == 1 and len(re.findall(r"\+- Window ", text)) == 1
    assert "min(price" in text and "unboundedpreceding$(), -2" in text  # a running minimum


@needs_data
def test_scan_reads_only_what_is_needed(spark, capsys):
    t = registry.Tables(spark, DATA)
    text = plan(t.lineitem.groupBy("l_partkey").count(), capsys)
    assert "ReadSchema: struct<l_partkey:bigint>" in text
    recent = t.orders.filter(F.col("o_orderdate") >= registry.RUN.run_date).select("o_orderkey")
    assert "GreaterThanOrEqual(o_orderdate" in plan(recent, capsys)


@needs_data
def test_top_rows_are_limited_before_the_shuffle(spark, capsys):
    t = registry.Tables(spark, DATA)
    text = plan(windows.latest_rows(registry.history(t), ["l_partkey"], ["day", "l_orderkey"], 3), capsys, "simple")
    assert text.count("WindowGroupLimit") == 2
    latest = plan(enrich.latest_snapshot(registry.history(t), ["l_partkey"], "day"), capsys, "simple")
    assert "partial_max" in latest


@needs_data
@pytest.mark.parametrize("name", ["q_feature_table", "q_intl_history", "q_price_summary", "q_auc", "q_upsert_set"])
def test_no_python_workers_or_cross_joins(spark, capsys, name):
    text = plan(QUERIES[name](spark, DATA), capsys)
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert all(name.startswith("q_") for name in QUERIES)
