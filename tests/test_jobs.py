"""Output jobs write their partitions and leave others in place."""

import datetime as dt

from rivalry.__main__ import LazyInputs
from rivalry.plans.jobs import JOBS, run_job
from rivalry.sources import fixtures as fx

RUN_DATES = {"brand_profile": fx.ORDER_RUN_DATE, "erosion_list": fx.ORDER_RUN_DATE,
             "market_profile": fx.ORDER_RUN_DATE, "coview": fx.CLICK_RUN_DATE,
             "coview_pooled": fx.CLICK_RUN_DATE}


def test_every_job_writes_its_partition(spark, small_dir, tmp_path):
    inputs = LazyInputs(spark, small_dir, {})
    for name in JOBS:
        if name == "similarity_merge":
            continue
        run = RUN_DATES.get(name, fx.SIMILARITY_RUN_DATE)
        out = str(tmp_path / name)
        run_job(name, inputs, out, run)
        back = spark.read.parquet(out)
        assert "dt" in back.columns
        assert {r.dt for r in back.select("dt").distinct().collect()} == {run}


def test_brand_profile_rerun_keeps_other_categories(spark, small_dir, tmp_path):
    inputs = LazyInputs(spark, small_dir, {})
    out = str(tmp_path / "profile")
    run = dt.date(2001, 8, 1)
    run_job("brand_profile", inputs, out, run)
    before = spark.read.parquet(out).groupBy("cid3").count().collect()
    cats = sorted(r.cid3 for r in before)
    run_job("brand_profile", inputs, out, run, categories=cats[:1])
    after = {r.cid3: r["count"] for r in spark.read.parquet(out).groupBy("cid3").count().collect()}
    assert after == {r.cid3: r["count"] for r in before}


def test_similarity_merge_from_written_outputs_equals_one_pass(spark, small_dir, tmp_path):
    inputs = LazyInputs(spark, small_dir, {})
    paths = {}
    for job, run in (("coview", fx.CLICK_RUN_DATE), ("overlap", fx.SIMILARITY_RUN_DATE),
                     ("volume", fx.SIMILARITY_RUN_DATE)):
        paths[job] = str(tmp_path / job)
        # an older partition that the merge must ignore
        run_job(job, inputs, paths[job], run - dt.timedelta(days=30))
        run_job(job, inputs, paths[job], run)
    outs = {f"{j}_out": spark.read.parquet(p) for j, p in paths.items()}
    merged_path = str(tmp_path / "merged")
    run_job("similarity_merge", LazyInputs(spark, small_dir, {}) | outs, merged_path, fx.SIMILARITY_RUN_DATE)
    got = sorted(tuple(r) for r in spark.read.parquet(merged_path).drop("dt").collect())
    from rivalry.plans.registry import QUERIES
    want = sorted(tuple(r) for r in QUERIES["similar_brands"](spark, small_dir).collect())
    assert got and got == want


def test_command_line_writes_partitions(spark, small_dir, tmp_path):
    import os
    import subprocess
    import sys
    out = str(tmp_path / "cli")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cmd = [sys.executable, "-m", "rivalry", "volume", "--run-date", "2001-07-31", "--out", out,
           "--data-dir", small_dir, "--master", "local[2]", "--categories", "ECONOMY,SMALL"]
    subprocess.run(cmd, cwd=repo, check=True, timeout=600, capture_output=True)
    back = spark.read.parquet(out)
    assert back.count() > 0
    assert {r.cid3 for r in back.select("cid3").distinct().collect()} <= {"ECONOMY", "SMALL"}
