"""Segment spend flow and the measures derived from it.

``spend_switch(A→B) = Σ switching_prob(s→d) · gmv(s)`` over SKU pairs with
``s`` in segment A and ``d`` in segment B, per category (and market).  Money
stays DECIMAL, so every sum is exact.

From the flow, per segment X of a category:

* out(X) = Σ_B flow(X→B), self(X) = flow(X→X)
* in(X)  = Σ_A flow(A→X), in_other(X) = Σ_{A≠X} flow(A→X)
* loyalty = self / out, switch_out_prob = 1 − loyalty (needs an X→X row)
* switch_in_prob = in_other / (Σ flow of the category − out) (needs X as a
  source and an inbound row from another segment)
* erode_amount = in − out (needs X on both sides)

All four totals come from a single aggregation: every flow row is emitted
once in its source role and once in its destination role and grouped by
segment, instead of four separate aggregates and three joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.functions.dates import dt_value
from rivalry.functions.joins import checked_broadcast
from rivalry.functions.numeric import RATIO_SCALE, money_out, money_ratio

# Flow sums: prob (6 decimals) × GMV (4 decimals), exact; 20 integer digits.
FLOW_TYPE = "decimal(30,10)"


def spend_flow(switch: DataFrame, labels: DataFrame, gmv: DataFrame, *,
               keys: Sequence[str] = ("cid3",), segment: str = "brand_code", hot_rows: int | None = None) -> DataFrame:
    """Spend flow between segments.

    ``switch``: (cid3, src_item_id, dst_item_id, switching_prob) of one snapshot.
    ``labels``: (*keys, sku_id, segment).  ``gmv``: (cid3, sku_id, gmv).
    Returns ``(*keys, src_<segment>, dst_<segment>, spend_switch)``; self
    flow (A→A) included.

    Plan: switching rows are joined with source GMV and source label on the
    same key (cid3, src_item_id), so both joins share one shuffle.  The
    products are then summed per (source segment, destination SKU) — partial
    sums map-side first — before the destination label is attached.  A
    single ``repartition`` by the destination keys would save one shuffle but
    skip the map-side combine, and AQE does not split skewed partitions of a
    user repartition: a destination SKU that a third of all pairs point to
    would land in one task.  With the aggregate, the hot SKU arrives
    pre-combined and the label join's shuffle stays splittable.  The first
    join needs no such care where a source SKU's rows are its substitute
    candidates, bounded by the SKUs of its category, not by data volume.
    Where they aren't, ``hot_rows`` takes the source SKUs with more pairs than
    that out of the join: their GMV and labels are a few rows, which meet the
    pairs as a size-checked broadcast.  Switching pairs, GMV and labels stored
    in buckets by (category, SKU) (``plans.layout``) meet without a shuffle.
    All inner joins: pairs without GMV or labels drop out.
    """
    keys = list(keys)
    src_seg, dst_seg = f"src_{segment}", f"dst_{segment}"
    sw = switch.select("cid3", "src_item_id", "dst_item_id", "switching_prob")
    g = gmv.select("cid3", F.col("sku_id").alias("src_item_id"), "gmv")
    src = labels.select(*keys, F.col("sku_id").alias("src_item_id"), F.col(segment).alias(src_seg))
    dst = labels.select(*keys, F.col("sku_id").alias("dst_item_id"), F.col(segment).alias(dst_seg))
    source = ["cid3", "src_item_id"]
    if hot_rows is None:
        met = sw.join(g, source).join(src, source)
    else:
        hot = checked_broadcast(sw.groupBy(*source).count().filter(F.col("count") > hot_rows).select(*source))
        of_hot = checked_broadcast(g.join(hot, source, "left_semi").join(src, source))
        met = (sw.join(hot, source, "left_anti").join(g, source).join(src, source)
                 .unionByName(sw.join(hot, source, "left_semi").join(of_hot, source)))
    partial = (met.groupBy(*keys, src_seg, "dst_item_id")
                  .agg(F.sum(F.col("switching_prob") * F.col("gmv")).alias("spend")))
    return (partial.join(dst, [*keys, "dst_item_id"])
                   .groupBy(*keys, src_seg, dst_seg)
                   .agg(F.sum("spend").cast(FLOW_TYPE).alias("spend_switch")))


def segment_totals(flow: DataFrame, *, keys: Sequence[str] = ("cid3",),
                   segment: str = "brand_code") -> DataFrame:
    """Per segment: out, self, in, in_other spend and the category total.

    Totals are NULL when the segment has no row of that kind, which is how
    the measures below reproduce the inner joins of the original jobs.
    """
    keys = list(keys)
    src, dst = F.col(f"src_{segment}"), F.col(f"dst_{segment}")
    spend = F.col("spend_switch")
    none = F.lit(None).cast(FLOW_TYPE)
    roles = F.array(
        F.struct(src.alias(segment), spend.alias("out_spend"),
                 F.when(src == dst, spend).alias("self_spend"),
                 none.alias("in_spend"), none.alias("in_other_spend")),
        F.struct(dst.alias(segment), none.alias("out_spend"), none.alias("self_spend"),
                 spend.alias("in_spend"), F.when(src != dst, spend).alias("in_other_spend")),
    )
    per_seg = (flow.select(*keys, F.inline(roles))
                   .groupBy(*keys, segment)
                   .agg(*[F.sum(c).cast(FLOW_TYPE).alias(c)
                          for c in ("out_spend", "self_spend", "in_spend", "in_other_spend")]))
    # One row per category; AQE turns this join into a broadcast at run time.
    per_cat = per_seg.groupBy(*keys).agg(F.sum("out_spend").cast(FLOW_TYPE).alias("cat_spend"))
    return per_seg.join(per_cat, keys)


def _loyalty_cols():
    loyalty = money_ratio("self_spend", "out_spend")
    return [loyalty.alias("loyalty"), F.round(F.lit(1.0) - loyalty, RATIO_SCALE).alias("switch_out_prob")]


def _switch_in_col():
    return money_ratio("in_other_spend", F.col("cat_spend") - F.col("out_spend")).alias("switch_in_prob")


def _erode_col():
    return money_out(F.col("in_spend") - F.col("out_spend")).alias("erode_amount")


def loyalty(flow: DataFrame, *, keys: Sequence[str] = ("cid3",), segment: str = "brand_code") -> DataFrame:
    """(*keys, segment, loyalty, switch_out_prob) for segments with self flow."""
    t = segment_totals(flow, keys=keys, segment=segment)
    return t.filter(F.col("self_spend").isNotNull()).select(*keys, segment, *_loyalty_cols())


def switch_in(flow: DataFrame, *, keys: Sequence[str] = ("cid3",), segment: str = "brand_code") -> DataFrame:
    """(*keys, segment, switch_in_prob)."""
    t = segment_totals(flow, keys=keys, segment=segment)
    return (t.filter(F.col("in_other_spend").isNotNull() & F.col("out_spend").isNotNull())
             .select(*keys, segment, _switch_in_col()))


def net_erosion(flow: DataFrame, *, keys: Sequence[str] = ("cid3",), segment: str = "brand_code") -> DataFrame:
    """(*keys, segment, erode_amount) = inbound − outbound flow."""
    t = segment_totals(flow, keys=keys, segment=segment)
    return (t.filter(F.col("in_spend").isNotNull() & F.col("out_spend").isNotNull())
             .select(*keys, segment, _erode_col()))


def competition_measures(flow: DataFrame, *, keys: Sequence[str] = ("cid3",),
                         segment: str = "brand_code") -> DataFrame:
    """Loyalty, switch-out, switch-in and erosion of the segments that have all
    of them — the inner join of D7 and D8 — from one aggregation."""
    t = segment_totals(flow, keys=keys, segment=segment)
    return (t.filter(F.col("self_spend").isNotNull() & F.col("in_other_spend").isNotNull())
             .select(*keys, segment, *_loyalty_cols(), _switch_in_col(), _erode_col()))


def erosion_pairs(flow: DataFrame, names: DataFrame, *, run_date) -> DataFrame:
    """Brand-to-brand net erosion.

    A flow A→B (A≠B) and its reverse B→A are one group under the pair's
    canonical key (the lesser code, the greater code), a two-column key, so
    that codes like 1|23 and 12|3 cannot collide; conditional sums give both
    directions from one shuffle of the flow, and the pair is emitted both
    ways.  Pairs present in one direction only are dropped.  Both brands get
    their names by inner joins, so a brand with k names yields k rows.
    """
    src, dst, spend = F.col("src_brand_code"), F.col("dst_brand_code"), F.col("spend_switch")
    both = (flow.filter(src != dst)
                .groupBy("cid3", F.least(src, dst).alias("lo"), F.greatest(src, dst).alias("hi"))
                .agg(F.sum(F.when(src < dst, spend)).cast(FLOW_TYPE).alias("up"),
                     F.sum(F.when(src > dst, spend)).cast(FLOW_TYPE).alias("down"))
                .filter(F.col("up").isNotNull() & F.col("down").isNotNull()))

    def way(a, b, there, back):
        return F.struct(F.col(a).alias("src_brand_code"), F.col(b).alias("dst_brand_code"),
                        F.col(there).alias("spend_switch"), F.col(back).alias("back"))

    pairs = both.select("cid3", F.inline(F.array(way("lo", "hi", "up", "down"), way("hi", "lo", "down", "up"))))
    src_names = names.select("cid3", F.col("brand_code").alias("src_brand_code"),
                             F.col("brand_name").alias("src_brand_name"))
    dst_names = names.select("cid3", F.col("brand_code").alias("dst_brand_code"),
                             F.col("brand_name").alias("dst_brand_name"))
    return (pairs.join(src_names, ["cid3", "src_brand_code"])
                 .join(dst_names, ["cid3", "dst_brand_code"])
                 .select("cid3", "src_brand_code", "src_brand_name", "dst_brand_code", "dst_brand_name",
                         money_out("spend_switch").alias("src_to_dst"),
                         money_out("back").alias("dst_to_src"),
                         money_out(F.col("spend_switch") - F.col("back")).alias("dst_net_erode_amount"),
                         dt_value(run_date).alias("dt")))


def scale_0_100(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("cid3",),
                suffix: str = "_p") -> DataFrame:
    """Min-max scale ``cols`` to 0..100 within each ``by`` group.

    One aggregation computes every min and max; a group whose range is 0
    (e.g. a single row) gets NULL instead of a division error.
    """
    by = list(by)
    stats = df.groupBy(*by).agg(*[e for c in cols for e in
                                  (F.min(c).alias(f"__min_{c}"), F.max(c).alias(f"__max_{c}"))])
    out = df.join(stats, by)
    for c in cols:
        lo, hi = F.col(f"__min_{c}"), F.col(f"__max_{c}")
        out = out.withColumn(f"{c}{suffix}", F.lit(100.0) * F.try_divide(F.col(c) - lo, hi - lo))
    return out.drop(*[f"__{m}_{c}" for c in cols for m in ("min", "max")])
