"""Property tests: co-view switching against brute force on random small click logs."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rivalry.operators.coview import coview_switch

CLICKS = ("sku_id bigint, request_tm timestamp_ntz, request_dt date, session_id bigint, bs string, "
          "brand_code string, cid3 string, dt date")
END = dt.date(2024, 1, 30)
DAYS = [dt.date(2024, 1, 28), dt.date(2024, 1, 29), dt.date(2024, 1, 30)]
KNOWN = ["A", "B", "C"]

click = st.tuples(
    st.sampled_from([0, 1, 2, None]),            # session
    st.sampled_from(["1", "13", "99"]),          # channel ('99' not kept)
    st.sampled_from(DAYS),
    st.sampled_from(["c", "d"]),                 # category
    st.sampled_from(KNOWN + ["Z"]),              # brand ('Z' unknown)
)


def brute_force(rows):
    kept = [r for r in rows if r[0] is not None and r[1] in ("1", "13") and r[4] in KNOWN]
    pv = Counter()
    for a in kept:
        for b in kept:
            if a[:4] == b[:4]:
                pv[(a[3], a[4], b[4])] += 1
    return pv


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(click, min_size=1, max_size=25), hot=st.integers(1, 4))
def test_coview_equals_brute_force(spark, rows, hot):
    df = spark.createDataFrame(
        [(1, dt.datetime.combine(d, dt.time(9)), d, s, bs, brand, cid3, d) for s, bs, d, cid3, brand in rows],
        CLICKS)
    brands = spark.createDataFrame([(b,) for b in KNOWN], "brand_code string")
    out = coview_switch(df, brands, end=END, hot_brands=hot).collect()
    got = {(r.cid3, r.from_brand_code, r.to_brand_code): r.page_views_switch for r in out}
    assert got == dict(brute_force(rows))
    totals = Counter()
    for (c, a, _), v in got.items():
        totals[(c, a)] += v
    for r in out:
        assert r.from_brand_total_switch == totals[(r.cid3, r.from_brand_code)]


SALES = "cid3 string, brand_code string, sku_id bigint, gmv decimal(22,4), sale_qtty double, dt date"


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(gmvs=st.lists(st.tuples(st.sampled_from(["c", "d"]), st.integers(-2, 12)), min_size=1, max_size=30),
       band=st.integers(1, 4))
def test_volume_neighbours_equal_band_join(spark, gmvs, band):
    from decimal import Decimal

    from rivalry.operators.volume import volume_neighbours, volume_rank
    day = dt.date(2001, 7, 31)
    rows = [(c, f"B{i}", i, Decimal(g), 1.0, day) for i, (c, g) in enumerate(gmvs)]
    ranked = volume_rank(spark.createDataFrame(rows, SALES), end=day)
    r = [(x.cid3, x.brand_code, x.gmv_rank) for x in ranked.collect()]
    # ranks: 1 + number of brands in the category with larger GMV; non-positive GMV dropped
    pos = [(c, f"B{i}", g) for i, (c, g) in enumerate(gmvs) if g > 0]
    want_rank = {(c, b): 1 + sum(1 for c2, _, g2 in pos if c2 == c and g2 > g) for c, b, g in pos}
    assert {(c, b): k for c, b, k in r} == want_rank
    want = {(c, a, b) for (c, a), ka in want_rank.items() for (c2, b), kb in want_rank.items()
            if c == c2 and 0 < abs(ka - kb) <= band}
    got = {(x.cid3, x.brand_code, x.similar_brand_code) for x in volume_neighbours(ranked, band).collect()}
    assert got == want


FLOW = "cid3 string, src_brand_code string, dst_brand_code string, spend_switch decimal(30,10)"


#: Ratios are rounded to six places.
ROUNDED = 5.1e-7


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=st.dictionaries(st.tuples(st.sampled_from("ABCD"), st.sampled_from("ABCD")),
                             st.integers(0, 50), min_size=1, max_size=12))
def test_flow_measures_equal_direct_computation(spark, edges):
    from decimal import Decimal

    import pytest

    from rivalry.operators import flow as fl
    df = spark.createDataFrame([("c", s, d, Decimal(v)) for (s, d), v in edges.items()], FLOW)
    out_ = {s: sum(v for (s2, _), v in edges.items() if s2 == s) for s, _ in edges}
    in_ = {d: sum(v for (_, d2), v in edges.items() if d2 == d) for _, d in edges}
    total = sum(edges.values())
    loy = {r.brand_code: r.loyalty for r in fl.loyalty(df).collect()}
    assert set(loy) == {s for (s, d) in edges if s == d}
    for b, v in loy.items():
        assert v == (pytest.approx(edges[(b, b)] / out_[b], abs=ROUNDED) if out_[b] else None)
    sin = {r.brand_code: r.switch_in_prob for r in fl.switch_in(df).collect()}
    assert set(sin) == {d for (s, d) in edges if s != d and d in out_}
    for b, v in sin.items():
        other = sum(val for (s, d), val in edges.items() if d == b and s != b)
        outside = total - out_[b]
        assert v == (pytest.approx(other / outside, abs=ROUNDED) if outside else None)
    ero = {r.brand_code: r.erode_amount for r in fl.net_erosion(df).collect()}
    assert ero == {b: float(in_[b] - out_[b]) for b in set(in_) & set(out_)}
