"""Date-partition helpers: latest snapshot (D1) and trailing windows."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivalry.sources.partitions import partition_values


def as_date(value) -> Column:
    """A date literal, or a date-typed column expression passed through."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        return F.lit(value)
    return F.to_date(F.lit(str(value)))


def latest_snapshot(df: DataFrame, date_col: str = "dt", by: Sequence[str] = ()) -> DataFrame:
    """Keep the rows whose ``date_col`` equals its maximum.

    Without ``by`` the newest date of a stored, partitioned table comes from
    its partitions' names, as a constant that picks its folder; of any other
    frame it is a scalar subquery: one tiny aggregate job whose value filters
    the scan, no join and no driver round trip.  With ``by`` (low-cardinality keys such as the
    category) the per-group maxima are semi-joined back on
    ``(*by, date_col)`` as a size-checked broadcast, so the table itself is
    never shuffled for the filter.
    """
    if not by:
        values = partition_values(df, [date_col])
        if values is None:
            newest = df.agg(F.max(date_col)).scalar()
        else:
            newest = F.lit(max((v for (v,) in values if v is not None), default=None)).cast(df.schema[date_col].dataType)
        return df.filter(F.col(date_col) == newest)
    return df.join(group_max(df, date_col, by), [*by, date_col], "left_semi")


def group_max(df: DataFrame, date_col: str, by: Sequence[str]) -> DataFrame:
    """``(*by, date_col)`` with the maximum per group, as a checked broadcast; from the partitions' names where they tell."""
    from rivalry.functions.joins import checked_broadcast
    values = partition_values(df, [*by, date_col])
    if values is not None:
        # A row per partition, and the frame's types: the newest of each group.
        names = [*by, date_col]
        rows = df.sparkSession.createDataFrame(values, ", ".join(f"`{c}` string" for c in names))
        df = rows.select(*(F.col(c).cast(df.schema[c].dataType).alias(c) for c in names)).dropna()
    return checked_broadcast(df.groupBy(*by).agg(F.max(date_col).alias(date_col)))


def trailing(df: DataFrame, date_col: str, end, days: int, end_inclusive: bool = True) -> DataFrame:
    """Rows with ``end - days <= date_col <= end`` (``< end`` when exclusive).

    With a literal ``end`` the bounds are constants, so the predicate reaches
    the parquet scan and prunes ``dt`` partitions.
    """
    return df.filter(window_predicate(F.col(date_col), end, days, end_inclusive))


def window_predicate(col: Column, end, days: int, end_inclusive: bool = True) -> Column:
    end_c = as_date(end)
    lower = col >= F.date_sub(end_c, days)
    upper = col <= end_c if end_inclusive else col < end_c
    return lower & upper


def dt_value(run_date) -> Column:
    """The output partition value of a run: ``yyyy-MM-dd`` string, as the output tables store ``dt``."""
    return F.date_format(as_date(run_date), "yyyy-MM-dd")
