"""Each clause of the queries matters on the test data: without it the oracle's result changes."""

import duckdb
import pytest

from rivalry import oracle

DIR = "/root/testdata/sf0.01"
#: query, part of its SQL, clause, what stands instead
CLAUSES = [
    ("sku_gmv", "gmv", "o.amount > 0 AND ", ""),
    ("overlap_by_category", "ov_den", "sale_qtty > 0 AND ", ""),
    ("coview_by_category", "cv_log", "AND brand_code IN (SELECT brand_code FROM sku_dim)", ""),
    ("coview_by_category", "cv_log", "dt >= DATE '2024-01-30' - 91 AND ", ""),
    ("coview_by_category", "cv_log", "'1', '13', '8', '311210'", "'1', '13', '8', '311210', '99'"),
    ("coview_pooled", "cvp_log", "dt < ", "dt <= "),
    ("brand_labels", "dim", "WHERE dt = (SELECT max(dt) FROM sku_dim)", ""),
    ("brand_labels", "picked", "max(brand_code)", "min(brand_code)"),
    ("brand_names", "picked", "max(brand_code)", "min(brand_code)"),
    ("brand_labels", "picked", "WHERE valid_flag = 1 ", ""),
    ("symmetric_matches", "match_latest", "WHERE dt = (SELECT max(dt) FROM sku_match)", ""),
    ("symmetric_matches", "sym", "DISTINCT ", ""),
    ("symmetric_matches", "sym", "WHERE cid3_1 = cid3_2", ""),
    ("declared_rivals", None, "WHERE s.dt = DATE '2001-07-31'", ""),
    ("latest_snapshot", "ends", "GROUP BY cid3", "GROUP BY cid3 HAVING max(dt) = (SELECT max(dt) FROM sku_switch)"),
    ("market_labels", "m_labels", "max(a.attr_value)", "min(a.attr_value)"),
    ("market_labels", "m_labels", "WHERE a.web_id = 0 ", ""),
    ("market_labels", "m_snap", "WHERE dt = (SELECT max(dt) FROM market_defs)", ""),
    ("volume_rank", "vol_rows", "DISTINCT ", ""),
    ("volume_rank", "vol_rank", "WHERE brand_gmv > 0", ""),
    ("volume_neighbours", "vol_pairs", "BETWEEN 1 AND 10", "BETWEEN 0 AND 10"),
    ("volume_neighbours", "vol_pairs", "BETWEEN 1 AND 10", "BETWEEN 1 AND 11"),
    ("overlap_by_category", "ov_num", "count(DISTINCT main_sku_id1)", "count(main_sku_id1)"),
    ("erosion_pairs", None, "WHERE f.src_brand_code <> f.dst_brand_code", ""),
    ("brand_spend_flow", "sw", "AND s.dt = e.end_dt", ""),
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "events", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name,part,clause,instead", CLAUSES)
def test_clause_matters(duck, monkeypatch, name, part, clause, instead):
    whole = duck.execute(f"SELECT * FROM ({oracle.statement(name)}) ORDER BY ALL").fetchall()
    table = oracle.FINAL if part is None else oracle.CTES
    body, deps = table[part or name]
    assert clause in body
    monkeypatch.setitem(table, part or name, (body.replace(clause, instead), deps))
    assert duck.execute(f"SELECT * FROM ({oracle.statement(name)}) ORDER BY ALL").fetchall() != whole
