"""Dates from partition names, and outputs that lookups can prune."""

import datetime as dt
import glob
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rivalry.functions.dates import group_max, latest_snapshot
from rivalry.sources.partitions import partition_values
from rivalry.sources.sinks import overwrite_partitions

DAYS = [dt.date(2001, 7, d) for d in (1, 9, 30)]


def frame(spark):
    return spark.createDataFrame([(i, d, c) for i, (d, c) in enumerate((d, c) for d in DAYS for c in ("a b", "c/d=e") if (d.day, c) != (30, "a b"))],
                                 "n long, dt date, cid3 string")


@pytest.fixture(params=["path", "table"])
def stored(request, spark, tmp_path):
    df = frame(spark)
    if request.param == "path":
        df.write.partitionBy("dt", "cid3").parquet(str(tmp_path / "t"))
        yield spark.read.parquet(str(tmp_path / "t"))
        return
    name = f"snapshots_{uuid.uuid4().hex}"
    df.write.partitionBy("dt", "cid3").option("path", str(tmp_path / "t")).saveAsTable(name)
    yield spark.table(name)
    spark.sql(f"DROP TABLE {name}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_day_comes_from_the_partitions(spark, stored):
    df = latest_snapshot(stored)
    assert [(r.n, r.dt, r.cid3) for r in df.collect()] == [(4, DAYS[2], "c/d=e")]
    assert plan(df).count("FileScan") == 1 and "ubquery" not in plan(df) and "Aggregate" not in plan(df)
    ends = group_max(stored, "dt", ["cid3"])
    assert sorted(map(tuple, ends.collect())) == [("a b", DAYS[1]), ("c/d=e", DAYS[2])]
    assert sorted(r.n for r in latest_snapshot(stored, by=["cid3"]).collect()) == [2, 4]


def test_other_frames_ask_their_data(spark, stored):
    for df in (stored.filter("n < 3"), frame(spark), stored.withColumn("dt", F.col("dt"))):
        assert partition_values(df, ["dt"]) is None
    assert partition_values(stored, ["n"]) is None
    assert [r.n for r in latest_snapshot(stored.filter("n < 3")).collect()] == [2]
    assert sorted(r.n for r in latest_snapshot(frame(spark), by=["cid3"]).collect()) == [2, 4]


def test_an_empty_table_has_no_newest_day(spark, tmp_path):
    name = f"empty_{uuid.uuid4().hex}"
    frame(spark).limit(0).write.partitionBy("dt").option("path", str(tmp_path / "e")).saveAsTable(name)
    assert latest_snapshot(spark.table(name)).collect() == []
    spark.sql(f"DROP TABLE {name}")


def test_clustered_files_prune_a_lookup(spark, tmp_path):
    """Files of a partition hold disjoint ranges of the cluster columns, so one brand is in one or two of them."""
    df = spark.range(20000).selectExpr("id AS n", "concat('b', lpad(cast(hash(id) % 500 + 500 AS string), 4, '0')) AS brand_code",
                                       "'2001-08-01' AS dt")
    target = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        overwrite_partitions(df, target, cluster=("brand_code",), clear=[{"dt": "2001-08-01"}])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = glob.glob(f"{target}/dt=*/*.parquet")
    assert len(files) >= 6
    ranges = []
    for f in files:
        about = pq.ParquetFile(f)
        brands = about.read(["brand_code"])["brand_code"].to_pylist()
        assert brands == sorted(brands)
        at = about.schema_arrow.get_field_index("brand_code")
        stats = [about.metadata.row_group(i).column(at).statistics for i in range(about.metadata.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    for brand in ("b0003", "b0500", "b0998"):
        assert sum(lo <= brand <= hi for lo, hi in ranges) <= 2
    back = spark.read.parquet(target)
    assert back.count() == 20000 and back.select("n").distinct().count() == 20000
