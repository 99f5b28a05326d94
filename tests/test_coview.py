"""Co-view switching (D14, D15) on hand-made click logs."""

import datetime as dt

import pytest

from rivalry.operators.coview import coview_switch

CLICKS = ("sku_id bigint, request_tm timestamp_ntz, request_dt date, session_id bigint, bs string, "
          "brand_code string, cid3 string, dt date")
DAY = dt.date(2024, 1, 10)


def click(session, brand, cid3="c", bs="1", day=DAY, tm=True):
    ts = dt.datetime.combine(day, dt.time(12)) if tm else None
    return (1, ts, day if tm else None, session, bs, brand, cid3, day)


def run(spark, rows, by_category=True, **kw):
    clicks = spark.createDataFrame(rows, CLICKS)
    brands = spark.createDataFrame([("A",), ("B",), ("C",)], "brand_code string")
    out = coview_switch(clicks, brands, end=dt.date(2024, 1, 30), by_category=by_category, **kw)
    return {(r.from_brand_code, r.to_brand_code): r for r in out.collect()}


def test_counts_ordered_pairs_including_self(spark):
    # Session with A, A, B: pairs A→A 4, A→B 2, B→A 2, B→B 1.
    out = run(spark, [click(1, "A"), click(1, "A"), click(1, "B")])
    pv = {k: r.page_views_switch for k, r in out.items()}
    assert pv == {("A", "A"): 4, ("A", "B"): 2, ("B", "A"): 2, ("B", "B"): 1}
    assert out[("A", "B")].from_brand_total_switch == 6
    assert out[("A", "B")].switch_prob == pytest.approx(2 / 6)


def test_pairs_need_same_session_day_channel_and_category(spark):
    rows = [click(1, "A"), click(1, "B", cid3="d"), click(1, "C", day=dt.date(2024, 1, 11)),
            click(2, "B"), click(1, "B", bs="13")]
    pv = {k: r.page_views_switch for k, r in run(spark, rows).items()}
    assert ("A", "B") not in pv and ("A", "C") not in pv
    assert pv[("A", "A")] == 1


def test_null_session_channel_or_time_and_unknown_brand_dropped(spark):
    rows = [click(None, "A"), click(1, "A", bs=None), click(3, "A", tm=False), click(4, "Z"),
            click(5, "B", bs="99")]
    assert run(spark, rows) == {}


def test_session_and_channel_are_separate_keys(spark):
    # With channels '1' and '11', (11, '1') and (1, '11') concatenate alike.
    rows = [click(11, "A", bs="1"), click(1, "B", bs="11")]
    pv = run(spark, rows, channels=("1", "11"))
    assert ("A", "B") not in pv and ("B", "A") not in pv


def test_window_end_inclusive_by_category_exclusive_pooled(spark):
    end = dt.date(2024, 1, 30)
    rows = [click(1, "A", day=end), click(1, "B", day=end)]
    assert run(spark, rows)[("A", "B")].page_views_switch == 1
    assert run(spark, rows, by_category=False) == {}


def test_pooled_sums_same_category_pairs_over_categories(spark):
    rows = [click(1, "A", cid3="c"), click(1, "B", cid3="c"), click(2, "A", cid3="d"), click(2, "B", cid3="d"),
            click(3, "A", cid3="c"), click(3, "B", cid3="d")]
    out = run(spark, rows, by_category=False)
    assert out[("A", "B")].page_views_switch == 2
    assert out[("A", "A")].from_shop_total_switch == 5


def test_probabilities_sum_to_one_and_counts_symmetric(spark, small_dir):
    from rivalry.plans.registry import QUERIES
    rows = QUERIES["coview_by_category"](spark, small_dir).collect()
    tot = {}
    pv = {}
    for r in rows:
        tot[(r.cid3, r.from_brand_code)] = tot.get((r.cid3, r.from_brand_code), 0) + r.switch_prob
        pv[(r.cid3, r.from_brand_code, r.to_brand_code)] = r.page_views_switch
    assert all(t == pytest.approx(1.0) for t in tot.values())
    assert all(pv[(c, b, a)] == v for (c, a, b), v in pv.items())


def test_hot_group_grid_is_exact(spark):
    # Split every group (hot_brands=1) into a grid of cells: same counts as unsplit.
    rows = [click(1, b) for b in "AABCC"] + [click(2, "B"), click(2, "C")]
    plain = {k: r.page_views_switch for k, r in run(spark, rows).items()}
    salted = {k: r.page_views_switch for k, r in run(spark, rows, hot_brands=1).items()}
    assert plain == salted
    assert plain[("A", "C")] == 4 and plain[("C", "C")] == 5


def test_grid_cells_stay_bounded_as_a_session_grows(spark):
    from pyspark.sql import functions as F

    from rivalry.operators.coview import GROUP_KEYS, HOT_GROUP_BRANDS, _brand_pairs
    assert HOT_GROUP_BRANDS > 0
    for brands in (40, 160, 320):
        counts = spark.range(brands).select(*[F.lit("g").alias(k) for k in GROUP_KEYS],
                                            F.col("id").cast("string").alias("brand_code"), F.lit(1).alias("k"))
        pairs = _brand_pairs(counts, 20)
        assert pairs.count() == brands ** 2
        cells = brands // 20
        of = F.pmod(F.xxhash64("from_brand_code"), F.lit(cells)), F.pmod(F.xxhash64("to_brand_code"), F.lit(cells))
        assert pairs.groupBy(*of).count().agg(F.max("count")).first()[0] <= 4 * 20 ** 2
