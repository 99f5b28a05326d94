"""Hand-made frames for the flow-based measures."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rivalry.operators import flow as fl

FLOW_SCHEMA = "cid3 string, src_brand_code string, dst_brand_code string, spend_switch decimal(30,10)"
NAMES_SCHEMA = "cid3 string, brand_code string, brand_name string"


def flow_df(spark, rows):
    return spark.createDataFrame([(c, s, d, Decimal(str(v))) for c, s, d, v in rows], FLOW_SCHEMA)


def names_df(spark, codes):
    return spark.createDataFrame([("c", b, f"N{b}") for b in codes], NAMES_SCHEMA)


def test_spend_flow_sums_prob_times_gmv(spark):
    sw = spark.createDataFrame(
        [("c", 1, 1, Decimal("0.5")), ("c", 1, 2, Decimal("0.5")), ("c", 2, 1, Decimal("1.0")),
         ("c", 3, 1, Decimal("1.0"))],
        "cid3 string, src_item_id bigint, dst_item_id bigint, switching_prob decimal(10,6)")
    labels = spark.createDataFrame([("c", 1, "A"), ("c", 2, "B"), ("c", 3, "B")],
                                   "cid3 string, sku_id bigint, brand_code string")
    gmv = spark.createDataFrame([("c", 1, Decimal("100")), ("c", 2, Decimal("10")), ("c", 3, Decimal("1"))],
                                "cid3 string, sku_id bigint, gmv decimal(22,4)")
    out = {(r.src_brand_code, r.dst_brand_code): float(r.spend_switch)
           for r in fl.spend_flow(sw, labels, gmv).collect()}
    assert out == {("A", "A"): 50.0, ("A", "B"): 50.0, ("B", "A"): 11.0}


def test_flow_drops_pairs_without_gmv_or_label(spark):
    sw = spark.createDataFrame([("c", 1, 2, Decimal("1")), ("c", 2, 9, Decimal("1"))],
                               "cid3 string, src_item_id bigint, dst_item_id bigint, switching_prob decimal(10,6)")
    labels = spark.createDataFrame([("c", 1, "A"), ("c", 2, "B")], "cid3 string, sku_id bigint, brand_code string")
    gmv = spark.createDataFrame([("c", 2, Decimal("5"))], "cid3 string, sku_id bigint, gmv decimal(22,4)")
    # 1→2 has no source GMV, 2→9 has no destination label.
    assert fl.spend_flow(sw, labels, gmv).count() == 0


def test_loyalty_and_switch_out_sum_to_one(spark):
    f = flow_df(spark, [("c", "A", "A", 30), ("c", "A", "B", 10), ("c", "B", "B", 5), ("c", "B", "A", 5)])
    rows = {r.brand_code: r for r in fl.loyalty(f).collect()}
    assert rows["A"].loyalty == pytest.approx(0.75)
    assert rows["B"].loyalty == pytest.approx(0.5)
    for r in rows.values():
        assert r.loyalty + r.switch_out_prob == pytest.approx(1.0)


def test_segment_without_self_flow_vanishes(spark):
    # A→B only: A has no self flow, B no outbound flow.
    f = flow_df(spark, [("c", "A", "B", 10)])
    assert fl.loyalty(f).count() == 0
    assert fl.switch_in(f).count() == 0
    assert fl.competition_measures(f).count() == 0


def test_switch_in_uses_flow_outside_the_segment(spark):
    f = flow_df(spark, [("c", "A", "A", 30), ("c", "A", "B", 10), ("c", "B", "B", 5), ("c", "B", "A", 5)])
    rows = {r.brand_code: r.switch_in_prob for r in fl.switch_in(f).collect()}
    # total 50; outside A = 50 - 40 = 10, A receives 5 from B.
    assert rows["A"] == pytest.approx(5 / 10)
    assert rows["B"] == pytest.approx(10 / 40)


def test_switch_in_zero_outside_is_null(spark):
    # B's outbound flow is 0, so everything outside A is 0.
    f = flow_df(spark, [("c", "A", "A", 10), ("c", "B", "A", 0)])
    rows = {r.brand_code: r.switch_in_prob for r in fl.switch_in(f).collect()}
    assert rows["A"] is None


def test_totals_are_per_category(spark):
    # Every total is grouped by category; a second category changes nothing.
    base = [("c", "A", "A", 30), ("c", "A", "B", 10), ("c", "B", "B", 5), ("c", "B", "A", 5)]
    other = [("d", "A", "A", 1000), ("d", "B", "A", 7), ("d", "A", "B", 3)]
    one = {r.brand_code: r.switch_in_prob for r in fl.switch_in(flow_df(spark, base)).collect()}
    both = fl.switch_in(flow_df(spark, base + other))
    both_c = {r.brand_code: r.switch_in_prob for r in both.filter("cid3 = 'c'").collect()}
    assert one == both_c
    assert both.filter("cid3 = 'd'").count() == 2


def test_net_erosion_cancels_self_flow_and_sums_to_zero(spark):
    f = flow_df(spark, [("c", "A", "A", 30), ("c", "A", "B", 10), ("c", "B", "B", 5), ("c", "B", "A", 4)])
    rows = {r.brand_code: r.erode_amount for r in fl.net_erosion(f).collect()}
    assert rows == {"A": -6.0, "B": 6.0}
    assert sum(rows.values()) == 0


def test_erosion_pairs_no_concat_collision(spark):
    # Codes (1, 23) and (12, 3) would collide under a concatenated key.
    f = flow_df(spark, [("c", "1", "23", 10), ("c", "23", "1", 4), ("c", "12", "3", 7), ("c", "3", "12", 2)])
    out = fl.erosion_pairs(f, names_df(spark, ["1", "23", "12", "3"]), run_date="2001-08-01").collect()
    got = {(r.src_brand_code, r.dst_brand_code): r.dst_net_erode_amount for r in out}
    assert got == {("1", "23"): 6.0, ("23", "1"): -6.0, ("12", "3"): 5.0, ("3", "12"): -5.0}


def test_erosion_pairs_one_way_dropped_and_antisymmetric(spark):
    # A→B without B→A is not listed.
    f = flow_df(spark, [("c", "A", "B", 10), ("c", "B", "C", 3), ("c", "C", "B", 1), ("c", "B", "B", 9)])
    out = fl.erosion_pairs(f, names_df(spark, ["A", "B", "C"]), run_date="2001-08-01").collect()
    got = {(r.src_brand_code, r.dst_brand_code): r.dst_net_erode_amount for r in out}
    assert got == {("B", "C"): 2.0, ("C", "B"): -2.0}


def test_erosion_pairs_name_fan_out(spark):
    # A brand with two names yields two rows per pair.
    f = flow_df(spark, [("c", "A", "B", 10), ("c", "B", "A", 3)])
    names = spark.createDataFrame([("c", "A", "a1"), ("c", "A", "a2"), ("c", "B", "b")], NAMES_SCHEMA)
    out = fl.erosion_pairs(f, names, run_date="2001-08-01")
    assert out.filter("src_brand_code = 'A'").count() == 2
    assert out.filter("dst_brand_code = 'A'").count() == 2


def test_scale_zero_range_is_null(spark):
    # One row, or equal values, give NULL instead of a division error.
    df = spark.createDataFrame([("c", 0.3), ("d", 0.2), ("d", 0.2), ("e", 0.1), ("e", 0.5), ("e", 0.3)],
                               "cid3 string, x double")
    rows = [(r.cid3, r.x_p) for r in fl.scale_0_100(df, ["x"]).collect()]
    assert [p for c, p in rows if c in ("c", "d")] == [None, None, None]
    e = sorted(p for c, p in rows if c == "e")
    assert e[0] == 0.0 and e[-1] == 100.0 and e[1] == pytest.approx(50.0)


def test_ratios_divide_exact_sums(spark):
    # Flows far below the four decimals of money: the ratios still stand.
    from decimal import Decimal

    from rivalry.operators.flow import loyalty, switch_in
    rows = [("c", "A", "A", Decimal("0.0000300000")), ("c", "A", "B", Decimal("0.0000100000")),
            ("c", "B", "A", Decimal("0.0000100000")), ("c", "B", "B", Decimal("0.0000100000"))]
    flow = spark.createDataFrame(rows, "cid3 string, src_brand_code string, dst_brand_code string, spend_switch decimal(30,10)")
    assert {r.brand_code: (r.loyalty, r.switch_out_prob) for r in loyalty(flow).collect()} == {"A": (0.75, 0.25), "B": (0.5, 0.5)}
    assert {r.brand_code: r.switch_in_prob for r in switch_in(flow).collect()} == {"A": 0.5, "B": 0.25}
