"""Overlap, volume neighbours, selection, merge and declared rivals."""

import datetime as dt
from decimal import Decimal

import pytest

from rivalry.functions.urls import normalise_url
from rivalry.operators import overlap as ov
from rivalry.operators import similarity as sim
from rivalry.operators.volume import volume_neighbours, volume_rank

MATCH = ("cid3_1 string, main_sku_id1 bigint, brand_code1 string, brand_name1 string, "
         "cid3_2 string, main_sku_id2 bigint, brand_code2 string, brand_name2 string")
SALES = "cid3 string, brand_code string, sku_id bigint, gmv decimal(22,4), sale_qtty double, dt date"
END = dt.date(2001, 7, 31)


def test_symmetric_matches_closed_under_swap(spark):
    m = spark.createDataFrame([("c", 1, "A", "a", "c", 2, "B", "b"), ("c", 3, "A", "a", "d", 4, "C", "c"),
                               ("c", 2, "B", "b", "c", 1, "A", "a")], MATCH)
    sym = {tuple(r) for r in ov.symmetric_matches(m).collect()}
    assert sym == {("c", 1, "A", "a", "c", 2, "B", "b"), ("c", 2, "B", "b", "c", 1, "A", "a")}
    pooled = ov.symmetric_matches(m, by_category=False)
    assert pooled.columns == ["main_sku_id1", "brand_code1", "brand_name1", "main_sku_id2", "brand_code2",
                              "brand_name2"]
    assert pooled.count() == 4


def test_overlap_ratio_can_exceed_one(spark):
    # 3 A-SKUs matched to B, only 2 A-SKUs sold in the window.
    m = spark.createDataFrame([("c", i, "A", "a", "c", 10 + i, "B", "b") for i in (1, 2, 3)], MATCH)
    sales = spark.createDataFrame([("c", "A", 1, Decimal(5), 1.0, END), ("c", "A", 7, Decimal(5), 2.0, END),
                                   ("c", "A", 8, Decimal(5), 0.0, END),
                                   ("c", "A", 9, Decimal(5), 3.0, END - dt.timedelta(days=200))], SALES)
    out = {(r.brand_code1, r.brand_code2): r for r in
           ov.sku_overlap(ov.symmetric_matches(m), sales, end=END).collect()}
    assert out[("A", "B")].match_sku_num == 3 and out[("A", "B")].sku_num == 2
    assert out[("A", "B")].overlap_ratio == pytest.approx(1.5)
    assert ("B", "A") not in out  # B sold nothing: inner join drops it


def test_pooled_overlap_denominator_is_matched_skus(spark):
    m = spark.createDataFrame([("c", 1, "A", "a", "c", 10, "B", "b"), ("c", 2, "A", "a", "d", 20, "C", "c"),
                               ("c", 1, "A", "a", "d", 21, "C", "c")], MATCH)
    out = {(r.brand_code1, r.brand_code2): r for r in
           ov.sku_overlap_pooled(ov.symmetric_matches(m, by_category=False)).collect()}
    assert out[("A", "B")].sku_num == 2 and out[("A", "B")].overlap_ratio == pytest.approx(0.5)
    assert out[("A", "C")].match_sku_num == 2 and out[("A", "C")].overlap_ratio == pytest.approx(1.0)


def sales_rows(values, cid3="c"):
    rows = []
    for i, (brand, gmv) in enumerate(values):
        rows.append((cid3, brand, i, Decimal(str(gmv)), 1.0, END))
    return rows


def test_volume_rank_dedupes_equal_rows_by_default(spark):
    # Two SKU-days of A with equal GMV count once unless dedupe_rows=False.
    df = spark.createDataFrame(sales_rows([("A", 5), ("A", 5), ("B", 7), ("C", 0)]), SALES)
    r = {x.brand_code: x for x in volume_rank(df, end=END).collect()}
    assert float(r["A"].brand_gmv) == 5 and r["B"].gmv_rank == 1 and r["A"].gmv_rank == 2
    assert "C" not in r  # non-positive GMV dropped
    r2 = {x.brand_code: x for x in volume_rank(df, end=END, dedupe_rows=False).collect()}
    assert float(r2["A"].brand_gmv) == 10 and r2["A"].gmv_rank == 1


def test_volume_neighbours_band_and_ties(spark):
    # Tied brands share a rank and are never paired; band is 1..10 ranks.
    vals = [(f"B{i:02d}", 100 - i) for i in range(15)] + [("T", 100 - 3)]
    df = spark.createDataFrame(sales_rows(vals), SALES)
    pairs = {(r.brand_code, r.similar_brand_code) for r in volume_neighbours(volume_rank(df, end=END)).collect()}
    assert ("B03", "T") not in pairs and ("T", "B03") not in pairs
    assert ("B00", "B09") in pairs and ("B00", "B10") not in pairs  # ranks 1 and 11, 12 (T shares 4)
    assert all((b, a) in pairs for a, b in pairs)
    assert all(a != b for a, b in pairs)


def test_volume_neighbours_equal_brute_force_band_join(spark, small_dir):
    from rivalry.plans.registry import QUERIES
    ranked = QUERIES["volume_rank"](spark, small_dir).collect()
    want = {(a.cid3, a.brand_code, b.brand_code) for a in ranked for b in ranked
            if a.cid3 == b.cid3 and 0 < abs(a.gmv_rank - b.gmv_rank) <= 10}
    got = {(r.cid3, r.brand_code, r.similar_brand_code)
           for r in QUERIES["volume_neighbours"](spark, small_dir).collect()}
    assert got == want


COV = "cid3 string, from_brand_code string, to_brand_code string, switch_prob double"


def test_select_strong_keeps_ties_at_the_cut(spark):
    # 25 partners tied at the top all have rank 1 ≤ 20, so all are kept.
    rows = [("c", "A", f"P{i}", 0.5) for i in range(25)] + [("c", "A", "Z", 0.01)]
    df = spark.createDataFrame(rows, COV)
    out = sim.strong_coview(df).collect()
    assert len(out) == 25 and {r.similarity_type for r in out} == {"1"}


def test_select_strong_self_pair_uses_a_rank(spark):
    # The self pair A→A ranks first and counts in the average; the merge removes it.
    rows = [("c", "A", "A", 0.9)] + [("c", "A", f"P{i}", 0.8) for i in range(20)] + [("c", "A", "Q", 0.7)]
    df = spark.createDataFrame(rows, COV)
    kept = sim.strong_coview(df, top_n=20)
    assert kept.count() == 21  # A→A (rank 1) + 20 tied at rank 2
    merged = sim.merge_similarity(kept).collect()
    assert len(merged) == 20 and all(r.brand_code_origin != r.brand_code_similar for r in merged)


def test_strict_and_non_strict_average(spark):
    # Both partners score exactly the average: kept for co-view (>=), dropped for overlap (>).
    cov = spark.createDataFrame([("c", "A", "B", 0.5), ("c", "B", "A", 0.5)], COV)
    assert sim.strong_coview(cov).count() == 2
    ovl = spark.createDataFrame([("c", "A", "B", 0.5), ("c", "B", "A", 0.5)],
                                "cid3 string, brand_code1 string, brand_code2 string, overlap_ratio double")
    assert sim.strong_overlap(ovl).count() == 0


def test_pairs_are_computed_once(spark):
    """Average and rank read the stored pairs: each row of the frame is computed a single time."""
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    def see(x):
        seen.add(1)
        return x

    rows = [("c", f"A{i % 7}", f"P{i}", 0.1 * (i % 9)) for i in range(120)]
    df = spark.createDataFrame(rows, COV).withColumn("switch_prob", F.udf(see, "double")("switch_prob"))
    assert sim.strong_coview(df).count() > 0 and seen.value == 120


def test_merge_keeps_duplicates_across_types(spark):
    a = spark.createDataFrame([("c", "A", "B", "1")], "cid3 string, brand_code_origin string, "
                              "brand_code_similar string, similarity_type string")
    b = spark.createDataFrame([("c", "A", "B", "3"), ("c", "A", "A", "3")], a.schema)
    assert sorted(r.similarity_type for r in sim.merge_similarity(b, a).collect()) == ["1", "3"]


@pytest.mark.parametrize("url,want", [
    ("https://shop1.example.com/", "http://shop1.example.com"),
    ("http://shop1.example.com", "http://shop1.example.com"),
    ("http://a.com//", "http://a.com/"),
    ("", None), ("nocolon", None), ("http://a:80/", None), ("http:", None), (None, None),
])
def test_normalise_url(spark, url, want):
    # Malformed URLs give NULL.
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(normalise_url("u").alias("n")).first().n == want


def test_declared_rivals_join_on_normalised_url(spark):
    links = spark.createDataFrame([(1, "https://shop7.example.com/"), (1, "https://shop7.example.com/"),
                                   (2, "nocolon")], "vender_id bigint, similarity_url string")
    shops = spark.createDataFrame([(7, "http://shop7.example.com", END), (8, "http://shop8.example.com", END)],
                                  "vender_id bigint, shop_url string, dt date")
    out = [tuple(r) for r in sim.declared_rivals(links, shops, shops_date=END).collect()]
    assert out == [(1, 7, "4")]
