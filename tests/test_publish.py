"""Two-phase publication: a run that dies at any step leaves each partition old or new, and the next run finishes it."""

import uuid

import pytest
from pyspark.sql import functions as F

from rivalry.sources import publish
from rivalry.sources.sinks import overwrite_partitions


class Killed(Exception):
    pass


def killed_at(n):
    """A step function that dies before the n-th step, and the steps that it saw."""
    seen = []

    def step(name):
        if len(seen) == n:
            raise Killed(name)
        seen.append(name)

    return step, seen


def frame(spark, rows):
    return spark.createDataFrame(rows, "n long, dt string, cid3 string")


OLD = [(1, "2001-08-01", "a b"), (2, "2001-08-01", "c/d"), (3, "2001-08-02", "a b"), (9, "2001-08-02", None)]
NEW = [(10, "2001-08-01", "a b"), (11, "2001-08-01", "a b"), (12, "2001-08-01", "e=f")]
CLEAR = [{"dt": "2001-08-01"}]
PARTS = ("dt", "cid3")


def by_partition(rows):
    out = {}
    for n, *part in rows:
        out.setdefault(tuple(part), []).append(n)
    return out


@pytest.fixture(params=["path", "table"])
def target(request, spark, tmp_path):
    if request.param == "path":
        yield str(tmp_path / "out")
        return
    name = f"published_{uuid.uuid4().hex}"
    location = str(tmp_path / "table")
    spark.sql(f"CREATE TABLE {name} (n BIGINT, dt STRING, cid3 STRING) USING parquet PARTITIONED BY (dt, cid3) LOCATION '{location}'")
    yield f"table:{name}"
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("clear", [(), CLEAR], ids=["dynamic", "static"])
def test_dies_at_every_step(spark, target, clear):
    key = lambda r: str(r)
    want = [r for r in OLD if r[1:] != ("2001-08-01", "a b") and not (clear and r[1] == "2001-08-01")] + NEW
    for n in range(30):
        overwrite_partitions(frame(spark, OLD), target, PARTS, clear=[{"dt": "2001-08-01"}, {"dt": "2001-08-02"}])
        before = by_partition(stored_any(spark, target))
        step, seen = killed_at(n)
        try:
            overwrite_partitions(frame(spark, NEW), target, PARTS, clear=clear, step=step)
            break
        except Killed:
            pass
        # Nothing is lost: each partition is found old or new, or stands aside for the moment between two renames.
        found, after = by_partition(stored_any(spark, target)), by_partition(want)
        between = bool(seen) and seen[-1].startswith("aside")
        for part in set(before) | set(found):
            if part in found:
                assert found[part] in (before.get(part), after.get(part))
            else:
                assert part not in after or part not in before or between
        finished = publish.recover(spark, target, abandoned=True)
        assert len(finished) == (n > 1)  # the manifest is the second step
        assert sorted(stored_any(spark, target), key=key) == sorted(want if finished else OLD, key=key)
    assert n > 4
    assert sorted(stored_any(spark, target), key=key) == sorted(want, key=key)
    assert publish.recover(spark, target, abandoned=True) == []


def stored_any(spark, target):
    if target.startswith("table:"):
        spark.catalog.refreshTable(target[6:])
        df = spark.table(target[6:])
    else:
        df = spark.read.schema("n long, dt string, cid3 string").parquet(target)
    return sorted((tuple(r) for r in df.select("n", "dt", "cid3").collect()), key=str)


def test_a_killed_run_is_finished_by_the_next(spark, target):
    overwrite_partitions(frame(spark, OLD), target, PARTS)
    with pytest.raises(Killed):
        overwrite_partitions(frame(spark, NEW), target, PARTS, clear=CLEAR, step=killed_at(3)[0])
    overwrite_partitions(frame(spark, [(50, "2001-08-03", "z")]), target, PARTS)
    assert by_partition(stored_any(spark, target)) == by_partition([r for r in OLD if r[1] != "2001-08-01"] + NEW + [(50, "2001-08-03", "z")])


def test_a_frame_that_fails_or_reads_its_target_loses_nothing(spark, target):
    overwrite_partitions(frame(spark, OLD), target, PARTS)
    before = stored_any(spark, target)
    bad = frame(spark, NEW).withColumn("n", F.expr("if(n = 12, raise_error('no'), n)").cast("long"))
    with pytest.raises(Exception, match="no"):
        overwrite_partitions(bad, target, PARTS, clear=CLEAR)
    assert stored_any(spark, target) == before
    own = spark.table(target[6:]) if target.startswith("table:") else spark.read.schema("n long, dt string, cid3 string").parquet(target)
    overwrite_partitions(own.filter("dt = '2001-08-01'").withColumn("n", F.col("n") + 100), target, PARTS, clear=CLEAR)
    assert stored_any(spark, target) == sorted(((n + 100 * (d == "2001-08-01"), d, c) for n, d, c in before), key=str)


def test_an_empty_result_clears_its_day(spark, target):
    overwrite_partitions(frame(spark, OLD), target, PARTS)
    overwrite_partitions(frame(spark, OLD).limit(0), target, PARTS, clear=CLEAR)
    assert stored_any(spark, target) == sorted((r for r in OLD if r[1] != "2001-08-01"), key=str)
    root = publish._described(spark, target[6:])["Location"] if target.startswith("table:") else target
    assert publish.Folders(spark, root).names(f"{root}/{publish.RUNS}") == []


def test_values_must_name_the_first_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="first partition columns"):
        overwrite_partitions(frame(spark, NEW), str(tmp_path / "x"), PARTS, clear=[{"cid3": "a b"}])
