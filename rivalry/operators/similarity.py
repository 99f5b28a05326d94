"""Selection and merge of similar brands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivalry.functions.joins import checked_broadcast
from rivalry.functions.urls import normalise_url
from rivalry.params import (OVERLAP_TOP_N, SWITCH_TOP_N, TYPE_DECLARED, TYPE_OVERLAP,
                            TYPE_SWITCH, TYPE_VOLUME)
from rivalry.sources.tables import stored

OUT_COLS = ["cid3", "brand_code_origin", "brand_code_similar", "similarity_type"]


def select_strong(df: DataFrame, *, origin: str, similar: str, score: str, top_n: int,
                  strict: bool, sim_type: str, group: Sequence[str] = ("cid3",)) -> DataFrame:
    """Keep, per origin brand, the top-N partners scoring at least the category average.

    ``rank()`` by score descending within (category, origin) — ties kept;
    the category average includes every row (self pairs too).  Average and
    rank both need all pairs, and the pairs come from a far larger log: they
    are computed once and stored, the average is taken from the stored table
    and broadcast back behind a size check, so the ranked pairs are not
    shuffled again on the few category keys.
    ``strict`` selects ``score > avg`` instead of ``score >= avg``.
    """
    group = list(group)
    pairs = stored(df, "pairs")
    w = Window.partitionBy(*group, origin).orderBy(F.col(score).desc())
    ranked = pairs.withColumn("__rank", F.rank().over(w))
    avg = checked_broadcast(pairs.groupBy(*group).agg(F.avg(score).alias("__avg")))
    above = F.col(score) > F.col("__avg") if strict else F.col(score) >= F.col("__avg")
    return (ranked.join(avg, group)
                  .filter(above & (F.col("__rank") <= top_n))
                  .select(*group, F.col(origin).alias("brand_code_origin"),
                          F.col(similar).alias("brand_code_similar"),
                          F.lit(sim_type).alias("similarity_type")))


def strong_coview(coview: DataFrame, top_n: int = SWITCH_TOP_N) -> DataFrame:
    """Co-view partners with ``switch_prob >= avg`` and rank ≤ 20 (type 1)."""
    return select_strong(coview, origin="from_brand_code", similar="to_brand_code",
                         score="switch_prob", top_n=top_n, strict=False, sim_type=TYPE_SWITCH)


def strong_overlap(overlap: DataFrame, top_n: int = OVERLAP_TOP_N) -> DataFrame:
    """Overlap partners with ``overlap_ratio > avg`` and rank ≤ 30 (type 2)."""
    return select_strong(overlap, origin="brand_code1", similar="brand_code2",
                         score="overlap_ratio", top_n=top_n, strict=True, sim_type=TYPE_OVERLAP)


def volume_similar(neighbours: DataFrame) -> DataFrame:
    """Every volume neighbour pair (type 3)."""
    return neighbours.select("cid3", F.col("brand_code").alias("brand_code_origin"),
                             F.col("similar_brand_code").alias("brand_code_similar"),
                             F.lit(TYPE_VOLUME).alias("similarity_type"))


def merge_similarity(*typed: DataFrame) -> DataFrame:
    """UNION ALL of typed pair lists without self pairs (D23); no dedup across types."""
    out = typed[0].select(*OUT_COLS)
    for df in typed[1:]:
        out = out.unionByName(df.select(*OUT_COLS))
    return out.filter(F.col("brand_code_origin") != F.col("brand_code_similar"))


def declared_rivals(links: DataFrame, shops: DataFrame, *, shops_date) -> DataFrame:
    """Vendors' declared rivals matched to shops by normalised URL (D22, type 4).

    ``(pop_id_origin, pop_id_similar, similarity_type)``.  Malformed URLs
    normalise to NULL and fall out of the inner join.
    """
    l = (links.select(F.col("vender_id").alias("pop_id_origin"), "similarity_url").distinct()
              .select("pop_id_origin", normalise_url("similarity_url").alias("url")))
    s = shops.filter(F.col("dt") == F.lit(shops_date)).select(
        F.col("vender_id").alias("pop_id_similar"), F.col("shop_url").alias("url"))
    return (l.join(s, "url")
             .select("pop_id_origin", "pop_id_similar", F.lit(TYPE_DECLARED).alias("similarity_type"))
             .distinct())
