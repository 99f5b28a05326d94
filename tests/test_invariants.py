"""Invariants over the registered queries on the sf0.001 tables."""

from collections import defaultdict

import pytest

from rivalry.plans.registry import QUERIES


def rows(spark, d, name):
    return QUERIES[name](spark, d).collect()


def test_loyalty_in_unit_interval_and_complements_switch_out(spark, small_dir):
    out = rows(spark, small_dir, "loyalty")
    assert out
    for r in out:
        assert 0.0 <= r.loyalty <= 1.0
        assert r.loyalty + r.switch_out_prob == pytest.approx(1.0)


def test_profile_scaled_columns_span_0_to_100(spark, small_dir):
    out = rows(spark, small_dir, "brand_profile")
    by_cat = defaultdict(list)
    for r in out:
        by_cat[r.cid3].append(r)
        assert r.domain == "brand" and r.dt == "2001-08-01"
        if r.loyalty_p is not None:
            assert r.loyalty_p + r.switch_out_p == pytest.approx(100.0)
    for cat, rs in by_cat.items():
        for col in ("switch_in_p", "switch_out_p", "loyalty_p"):
            vals = [getattr(r, col) for r in rs if getattr(r, col) is not None]
            if len(set(vals)) > 1:
                assert min(vals) == 0.0 and max(vals) == pytest.approx(100.0)


def test_erosion_pairs_antisymmetric(spark, small_dir):
    out = rows(spark, small_dir, "erosion_pairs")
    net = {(r.cid3, r.src_brand_code, r.dst_brand_code): r.dst_net_erode_amount for r in out}
    assert net
    for (c, a, b), v in net.items():
        assert a != b
        assert net[(c, b, a)] == pytest.approx(-v)


def test_flow_totals_match_net_erosion(spark, small_dir):
    flow = rows(spark, small_dir, "brand_spend_flow")
    inflow, outflow = defaultdict(float), defaultdict(float)
    for r in flow:
        inflow[(r.cid3, r.dst_brand_code)] += r.spend_switch
        outflow[(r.cid3, r.src_brand_code)] += r.spend_switch
    for r in rows(spark, small_dir, "net_erosion"):
        key = (r.cid3, r.brand_code)
        assert r.erode_amount == pytest.approx(inflow[key] - outflow[key], abs=1e-3)


def test_merged_list_has_no_self_pairs_and_known_types(spark, small_dir):
    out = rows(spark, small_dir, "similar_brands")
    assert out
    assert all(r.brand_code_origin != r.brand_code_similar for r in out)
    assert {r.similarity_type for r in out} <= {"1", "2", "3"}


def test_symmetric_matches_closed_under_swap(spark, small_dir):
    out = {tuple(r) for r in rows(spark, small_dir, "symmetric_matches")}
    assert out
    for r in out:
        assert (r[4], r[5], r[6], r[7], r[0], r[1], r[2], r[3]) in out


def test_market_profile_one_output_for_all_attributes(spark, small_dir):
    out = rows(spark, small_dir, "market_profile")
    markets = {(r.cid3, r.market) for r in out}
    # S3: both attributes of a category are present in the one output.
    cats = {c for c, _ in markets}
    assert any({(c, "color"), (c, "shape")} <= markets for c in cats)


def test_market_profile_reads_one_definitions_snapshot(spark, small_dir):
    import datetime as dt
    from pyspark.sql import functions as F
    from rivalry.plans import profiles
    from rivalry.sources import fixtures as fx
    defs = fx.market_defs(spark, small_dir)
    old_day = dt.date(2001, 1, 1)
    older = defs.filter(F.col("attr_name") == "color").withColumn("dt", F.lit(old_day))
    both = defs.unionByName(older)
    args = (fx.sku_attrs(spark, small_dir), both, fx.sku_switch(spark, small_dir), fx.order_det(spark, small_dir))
    latest = profiles.market_profile(*args, run_date=fx.ORDER_RUN_DATE)
    old = profiles.market_profile(*args, run_date=fx.ORDER_RUN_DATE, defs_date=old_day)
    assert {r.market for r in latest.collect()} == {"color", "shape"}
    assert {r.market for r in old.collect()} == {"color"}
