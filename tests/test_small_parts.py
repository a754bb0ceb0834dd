"""Exact roots, numbers for JSON, report tables that are cut and pooled tokens."""

from __future__ import annotations

from tracklens.functions import scalars
from tracklens.operators import masks, reports


def test_exact_root(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 729, 730, -4, 4611686014132420609, 9223372036854775807, None)], "n long")
    got = {r.n: r.root for r in df.select("n", scalars.exact_root("n").alias("root")).collect()}
    assert got == {0: 0, 1: 1, 2: None, 729: 27, 730: None, -4: None, 4611686014132420609: 2147483647, 9223372036854775807: None, None: None}


def test_json_safe(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    assert [r.x for r in df.select(scalars.json_safe("x").alias("x")).collect()] == [1.5, None, None, None, None]


def test_cut_tables_say_so(spark):
    rows = spark.range(5).coalesce(1)
    assert "only the first 3 rows are shown" in reports.html_table(rows, "t", limit=3)
    whole = reports.html_table(rows, "t", limit=5)
    assert "only the first" not in whole and whole.count("<td>") == 5


def test_pooled_tokens_odd_rows(spark):
    rows = [(1, 2.0, [1.0, 2.0]), (1, 0.0, [9.0, 9.0]), (1, None, [5.0, 5.0]), (1, 1.0, [4.0, None]), (2, 0.0, [3.0, 3.0]), (3, 1.0, None), (4, 1.0, []), (None, 1.0, [7.0, 8.0])]
    df = spark.createDataFrame(rows, "k int, weight double, token array<double>")
    got = {(r.k, r.dim): r.value for r in masks.pooled_tokens(df, ["k"]).collect()}
    assert got == {(1, 0): 2.0, (1, 1): 4 / 3, (2, 0): 0.0, (2, 1): 0.0, (None, 0): 7.0, (None, 1): 8.0}
    assert masks.pooled_tokens(df.limit(0), ["k"]).count() == 0
