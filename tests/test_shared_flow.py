"""One spend flow for several outputs, computed once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rivalry.__main__ import LazyInputs
from rivalry.plans import shared
from rivalry.plans.jobs import run_job, run_shared
from rivalry.sources import fixtures as fx

RUN = fx.ORDER_RUN_DATE
OUTS = ("brand_profile", "erosion_list")


def rows(spark, path):
    df = spark.read.parquet(path)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def counted(spark, df, column):
    """``df`` with a column that counts each time a row of it is computed."""
    seen = spark.sparkContext.accumulator(0)

    def see(x):
        seen.add(1)
        return x

    return df.withColumn(column, F.udf(see, df.schema[column].dataType)(F.col(column))), seen


@pytest.mark.parametrize("categories", [None, ["ECONOMY", "SMALL"]])
def test_outputs_equal_the_single_jobs(spark, small_dir, tmp_path, categories):
    inputs = LazyInputs(spark, small_dir, {})
    run_shared({n: str(tmp_path / f"shared_{n}") for n in OUTS}, inputs, RUN, categories)
    for n in OUTS:
        run_job(n, inputs, str(tmp_path / n), RUN, categories)
        assert (got := rows(spark, str(tmp_path / f"shared_{n}"))) and got == rows(spark, str(tmp_path / n))


def test_orders_and_switching_are_read_once(spark, small_dir, tmp_path):
    def run(name, job):
        inputs, seen = dict(sku_dim=fx.sku_dim(spark, small_dir)), {}
        inputs["order_det"], seen["order_det"] = counted(spark, fx.order_det(spark, small_dir), "amount")
        inputs["sku_switch"], seen["sku_switch"] = counted(spark, fx.sku_switch(spark, small_dir), "switching_prob")
        job(inputs, str(tmp_path / name))
        return {k: v.value for k, v in seen.items()}

    one = run("one", lambda i, out: run_job("erosion_list", i, out, RUN))
    both = run("both", lambda i, out: run_shared({n: f"{out}-{n}" for n in OUTS}, i, RUN))
    assert both == one and all(one.values())


def test_a_run_that_died_continues_from_the_stored_flow(spark, small_dir, tmp_path, monkeypatch):
    inputs = LazyInputs(spark, small_dir, {})
    with pytest.raises(Exception, match="no such place"):
        run_shared({"erosion_list": str(tmp_path / "a"), "brand_profile": _bad(monkeypatch)}, inputs, RUN, ["LARGE"])
    monkeypatch.undo()
    monkeypatch.setattr(shared.profiles, "brand_flow_inputs", None)  # a second computation would fail
    outs = {n: str(tmp_path / n) for n in OUTS}
    run_shared(outs, inputs, RUN, ["LARGE"])
    assert all(rows(spark, p) for p in outs.values())


def _bad(monkeypatch):
    from rivalry.plans import jobs

    real = jobs.overwrite_partitions

    def write(df, target, *args, **more):
        if target == "bad":
            raise OSError("no such place")
        return real(df, target, *args, **more)

    monkeypatch.setattr(jobs, "overwrite_partitions", write)
    return "bad"


def test_the_key_follows_inputs_and_parameters(spark, small_dir, tmp_path):
    dim = fx.sku_dim(spark, small_dir)
    key = shared.input_key({"d": dim}, categories=None)
    assert key == shared.input_key({"d": fx.sku_dim(spark, small_dir)}, categories=None)
    assert len({key, shared.input_key({"d": dim}, categories=["a"]), shared.input_key({"d": dim.filter("sku_id > 3")}, categories=None)}) == 3
    path = str(tmp_path / "t")
    dim.write.parquet(path)
    before = shared.input_key({"d": spark.read.parquet(path)})
    dim.write.mode("append").parquet(path)
    assert before != shared.input_key({"d": spark.read.parquet(path)})
    memory = spark.range(3)
    assert shared.input_key({"d": memory}) != shared.input_key({"d": memory})


def test_only_outputs_of_the_flow(spark, small_dir, tmp_path):
    with pytest.raises(ValueError, match="coview"):
        run_shared({"coview": str(tmp_path / "x")}, {}, dt.date(2001, 8, 1))
