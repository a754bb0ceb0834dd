"""Rows that bounds on ids or time once left out."""

from __future__ import annotations

import datetime as dt

import pytest

from tracklens.plans import catalogue, views

MODALITIES = ("click", "view", "signup", "purchase")


@pytest.fixture(scope="module")
def tracks(spark, tmp_path_factory):
    """Customers 0..1502; users 0..2 have all modalities in frames 0..5 and 198..203."""
    path = tmp_path_factory.mktemp("tracks")
    spark.range(1503).withColumnRenamed("id", "c_custkey").write.parquet(f"{path}/customer.parquet")
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    cells = [(user, frame, m) for user in range(3) for frame in (*range(6), *range(198, 204)) for m in MODALITIES]
    rows = [(i, start + dt.timedelta(microseconds=views.FRAME_US * frame), user, m, 1.0, '{"k": 1}') for i, (user, frame, m) in enumerate(cells)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{path}/events.parquet")
    return str(path)


def test_all_customers_form_pairs(spark, tracks):
    rows = catalogue.QUERIES["q43_pair_modalities"](spark, tracks).collect()
    assert len(rows) == 1503 * 2
    late = {(r.src, r.tgt): r.drop_reason for r in rows if r.src >= 1500}
    assert len(late) == 6 and set(late.values()) == {"missing_target_purchase"}


def test_windows_reach_the_last_frame(spark, tracks):
    last = (204 - 6) // 3 + 1
    for name in ("q38_window_validity", "q45_manifest"):
        assert {r.clip_index for r in catalogue.QUERIES[name](spark, tracks).collect()} >= {1, last}
    whole = catalogue.QUERIES["q44_drop_counts"](spark, tracks).where("scene IS NULL").groupBy().sum("n").first()[0]
    assert whole + catalogue.QUERIES["q45_manifest"](spark, tracks).count() == 6 * last


def test_windows_of_every_base(spark, tmp_path):
    """All bases have windows, and as many as their frames hold."""
    rows = [(base, line, float(q)) for base in range(1, 8) for line, q in ((1, 700 if base == 4 else 50), (2, 40))]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    windows = {(r.base, r.clip_index) for r in catalogue.QUERIES["q40_overlap_chunks"](spark, str(tmp_path)).collect()}
    assert windows == {(base, k + 1) for base in range(1, 8) for k in range(23 if base == 4 else 2)}


def test_fresh_rows_meet_existing_ones(spark):
    data = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{data}/orders.parquet").selectExpr("o_orderkey % 700 AS k", "o_orderkey AS id", "o_orderstatus = 'O' AS fresh", "o_totalprice AS price").toPandas()
    both = orders.groupby("k").fresh.nunique()
    assert (both == 2).sum() > 100
    got = {r.k: r.price for r in catalogue.QUERIES["q68_upsert_summary"](spark, data).collect()}
    last = orders.sort_values(["fresh", "id"]).groupby("k").tail(1)
    assert got == pytest.approx(dict(zip(last.k, last.price.round(4), strict=True)))
