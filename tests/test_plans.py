"""What the physical plans must not, and must, contain."""

from __future__ import annotations

import re

import pytest

from tracklens.plans import catalogue

DATA = "/root/testdata/sf0.001"
#: Queries that run pixel kernels in Python, and those that read archives by a Python data source.
KERNELS = {"q80_ring_metrics", "q81_lifted_frames", "q98_mask_archives", "q99_sidecar_files", "q103_face_crops", "q105_isolated_failures"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_no_cross_products_and_native(spark, name):
    text = plan(catalogue.QUERIES[name](spark, DATA))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
    if name not in KERNELS:
        assert not re.search("Python|Pandas|MapInArrow|BatchEvalPython", text)
    assert "SinglePartition" not in text


def test_scans_are_pruned(spark):
    text = plan(catalogue.QUERIES["q38_window_validity"](spark, DATA))
    assert "props" not in re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    text = plan(catalogue.QUERIES["q69_label_join"](spark, DATA))
    assert all("text" not in schema for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text))


def test_filters_reach_the_scan(spark):
    from tracklens.plans import views

    text = plan(views.table(spark, DATA, "lineitem").where("l_linenumber = 3").select("l_orderkey"))
    assert "EqualTo(l_linenumber,3)" in text
