"""Input tables of the competition jobs, derived from the driver's test tables.

The jobs consume a SKU dimension, SKU→SKU switching probabilities, order
lines, SKU attributes, market definitions, a click log, matched SKU pairs,
daily SKU sales, declared rival links and vendor shops.  Those come from
upstream systems the library does not own; for testing they are derived
from the TPC-H-style tables as specified in FIXTURES.md.  Each input is
derived by Spark from the whole given tables and, like the upstream table it
stands in for, stored once per session as a parquet table under the
session's checkpoint directory (the cluster's shared ``spark.checkpoint.dir``);
queries read the stored table.  ``derive_<name>`` builds the lazy
derivation without storing it.
"""

from __future__ import annotations

import datetime as _dt
import functools
import hashlib
import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivalry.functions.numeric import AMOUNT_TYPE, GMV_TYPE
from rivalry.session import checkpoint_folder
from rivalry.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping (FIXTURES.md)
# ---------------------------------------------------------------------------
ORDER_RUN_DATE = _dt.date(2001, 8, 1)      # profile runs; latest switching snapshot of some categories
OTHER_SWITCH_DATE = _dt.date(2001, 7, 15)  # latest switching snapshot of the others
STALE_DIM_DATE = _dt.date(2001, 5, 1)      # older snapshot of the SKU dimension and market definitions
SIMILARITY_RUN_DATE = _dt.date(2001, 7, 31)  # "yesterday" for overlap / volume jobs
STALE_MATCH_DATE = _dt.date(2001, 6, 30)   # older snapshot of matched pairs and vendor shops
CLICK_RUN_DATE = _dt.date(2024, 1, 30)     # co-view runs
# user_id % 5 → channel code; '99' is not a kept channel.
CHANNEL_BY_MOD5 = ("1", "13", "8", "311210", "99")
# Values removed from the latest market definitions so the definition join bites.
EXCLUDED_MARKET_VALUES = ("red", "bolt")
PROB_SCALE = 1_000_000
# ---------------------------------------------------------------------------


def _rows(*structs: Column) -> Column:
    """The structs that aren't null, one row each."""
    return F.inline(F.array_compact(F.array(*structs)))


def derive_sku_dim(spark: SparkSession, data_dir: str) -> DataFrame:
    """SKU dimension (sku_id, cid3, cid3_name, brand_code, brand_name, valid_flag, dt).

    Some SKUs are listed under a second code or a second name, and an older
    snapshot lists some under another brand.
    """
    p = read_table(spark, data_dir, "part")
    key, brand = F.col("p_partkey"), F.col("p_brand")
    valid = F.when(F.col("p_size") % 10 == 0, 0).otherwise(1).cast("int")

    def listed(code, name, flag, dt):
        return F.struct(code.alias("brand_code"), name.alias("brand_name"), flag.alias("valid_flag"), F.lit(dt).alias("dt"))

    name = F.concat(F.lit("Name of "), brand)
    return p.select(
        key.alias("sku_id"), F.col("p_type").alias("cid3"), F.concat(F.lit("Category "), F.col("p_type")).alias("cid3_name"),
        _rows(listed(brand, name, valid, ORDER_RUN_DATE),
              F.when(key % 11 == 0, listed(F.concat(brand, F.lit("z")), name, valid, ORDER_RUN_DATE)),
              F.when(key % 7 == 0, listed(brand, F.concat(F.lit("Alias of "), brand), valid, ORDER_RUN_DATE)),
              F.when(key % 5 == 0, listed(F.concat(F.lit("Old#"), brand), F.concat(F.lit("Former "), brand),
                                          F.lit(1).cast("int"), STALE_DIM_DATE))))


def _dated_lines(spark: SparkSession, data_dir: str, *more: str) -> DataFrame:
    """(l_orderkey, l_partkey, amount, qty) of each order line, with the columns ``more`` of its order's rows.

    The amounts are made before the join, so its shuffle carries them instead of what they are made of.
    """
    key = F.col("l_orderkey")
    amount = (F.col("l_extendedprice").cast("decimal(12,2)")
              * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")))
    li = read_table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.when(key % 19 == 0, -amount).otherwise(amount).cast(AMOUNT_TYPE).alias("amount"),
        F.when(key % 23 == 0, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("qty"))
    o = read_table(spark, data_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("dt"))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(*more, "l_partkey", "dt", "amount", "qty")


def derive_order_det(spark: SparkSession, data_dir: str) -> DataFrame:
    """Order lines (sku_id, cid3, brand_code, okey, dt, amount decimal, qty).

    The orders of some keys are returns (negative amount) or have no quantity.
    """
    lines = _dated_lines(spark, data_dir, "l_orderkey")
    p = read_table(spark, data_dir, "part").select("p_partkey", "p_type", "p_brand")
    return (lines.join(p, lines.l_partkey == p.p_partkey)
                 .select(F.col("l_partkey").alias("sku_id"),
                         F.col("p_type").alias("cid3"),
                         F.col("p_brand").alias("brand_code"),
                         F.col("l_orderkey").alias("okey"),
                         "dt", "amount", "qty"))


def derive_sku_switch(spark: SparkSession, data_dir: str) -> DataFrame:
    """SKU→SKU switching probabilities (cid3, src_item_id, dst_item_id, switching_prob, dt).

    Stand-in built from basket co-occurrence: for each year, n(src, dst) =
    Σ over orders of k_src·k_dst (k = lines of the SKU in the order, same
    category, self pairs included); the probability is n over the source's
    total, floored to six decimals.  Each year of orders is one dated
    snapshot; the last one is dated differently by category.  The lines are
    dealt once by order, where they are counted and paired without a join
    (an order's SKUs are bounded by its lines), and the pairs once by source,
    which serves their sums and the source's total.
    """
    od = order_det(spark, data_dir)
    basket = ["yr", "okey", "cid3"]
    lines = od.select(F.year("dt").alias("yr"), "okey", "cid3", "sku_id").dropna(subset=basket)
    k = lines.repartition(*basket).groupBy(*basket, "sku_id").agg(F.count(F.lit(1)).alias("k"))
    held = k.groupBy(*basket).agg(F.collect_list(F.struct("sku_id", "k")).alias("skus"))
    a = held.select("yr", "cid3", "skus", F.explode("skus").alias("a"))
    pairs = a.select("yr", "cid3", "a", F.explode("skus").alias("b")).select(
        "yr", "cid3", F.col("a.sku_id").alias("src_item_id"), F.col("b.sku_id").alias("dst_item_id"),
        (F.col("a.k") * F.col("b.k")).alias("n"))
    source = ["yr", "cid3", "src_item_id"]
    n = pairs.repartition(*source).groupBy(*source, "dst_item_id").agg(F.sum("n").alias("n"))
    # A source SKU's partners are bounded by the SKUs it shares orders with.
    tot = F.sum("n").over(Window.partitionBy(*source))
    q = F.expr(f"(n * {PROB_SCALE}) div tot")
    prob = (q.cast("double") / PROB_SCALE).cast("decimal(10,6)")
    last = F.when(F.length("cid3") % 2 == 0, F.lit(ORDER_RUN_DATE)).otherwise(F.lit(OTHER_SWITCH_DATE))
    snap = F.when(F.col("yr") == ORDER_RUN_DATE.year, last).otherwise(F.make_date("yr", F.lit(12), F.lit(31)))
    return (n.withColumn("tot", tot)
             .select("cid3", "src_item_id", "dst_item_id",
                     prob.alias("switching_prob"), snap.alias("dt")))


def derive_sku_attrs(spark: SparkSession, data_dir: str) -> DataFrame:
    """I4: SKU attributes, long form (sku_id, cid3, attr_name, attr_value, web_id); some SKUs have two colours."""
    p = read_table(spark, data_dir, "part")
    words, key = F.split(F.col("p_name"), " "), F.col("p_partkey")

    def attr(name, value, web):
        return F.struct(F.lit(name).alias("attr_name"), value.alias("attr_value"), web.cast("int").alias("web_id"))

    other = F.when(key % 2 == 0, F.lit("amber")).otherwise(F.lit("zinc"))
    return p.select(key.alias("sku_id"), F.col("p_type").alias("cid3"), _rows(
        attr("color", F.element_at(words, 1), F.lit(0)),
        attr("shape", F.element_at(words, 2), F.when(F.col("p_size") % 10 == 0, 1).otherwise(0)),
        F.when(key % 9 == 0, attr("color", other, F.lit(0)))))


def derive_market_defs(spark: SparkSession, data_dir: str) -> DataFrame:
    """Market definitions (cid3, cid3_name, attr_name, attr_value, dt); the older snapshot has all values."""
    a = sku_attrs(spark, data_dir).filter(F.col("web_id") == 0).select("cid3", "attr_name", "attr_value").distinct()
    now = F.when(~F.col("attr_value").isin(*EXCLUDED_MARKET_VALUES), F.struct(F.lit(ORDER_RUN_DATE).alias("dt")))
    return a.select("cid3", F.concat(F.lit("Category "), F.col("cid3")).alias("cid3_name"), "attr_name", "attr_value",
                    _rows(now, F.struct(F.lit(STALE_DIM_DATE).alias("dt"))))


def derive_clicks(spark: SparkSession, data_dir: str) -> DataFrame:
    """Click log (sku_id, request_tm, request_dt, session_id, bs, brand_code, cid3, dt).

    Some clicks are 80 days older, some have no session, and some SKUs are of
    a brand that the SKU dimension doesn't know.
    """
    ev = read_table(spark, data_dir, "events")
    p = read_table(spark, data_dir, "part").select(
        F.col("p_partkey").alias("sku_id"),
        F.when(F.col("p_partkey") % 17 == 0, F.lit("Ghost")).otherwise(F.col("p_brand")).alias("brand_code"),
        F.col("p_type").alias("cid3"))
    bs = F.element_at(F.array(*[F.lit(c) for c in CHANNEL_BY_MOD5]),
                      (F.col("user_id") % 5 + 1).cast("int"))
    ts = F.when(F.col("event_id") % 37 == 0, F.col("ts") - F.expr("INTERVAL 80 DAYS")).otherwise(F.col("ts"))
    log = ev.select(
        (F.regexp_extract("props", r"([0-9]+)", 1).cast("bigint") + 100 * (F.col("event_id") % 20)).alias("sku_id"),
        ts.alias("request_tm"),
        F.to_date(ts).alias("request_dt"),
        F.when(F.col("event_id") % 31 != 0, F.col("user_id")).alias("session_id"),
        bs.alias("bs"),
        F.to_date(ts).alias("dt"))
    return log.join(p, "sku_id").select(
        "sku_id", "request_tm", "request_dt", "session_id", "bs", "brand_code", "cid3", "dt")


def derive_sku_match(spark: SparkSession, data_dir: str) -> DataFrame:
    """Matched SKU pairs (cid3_1, main_sku_id1, brand_code1, brand_name1, …2, dt).

    Stand-in matcher: two SKUs of the same name match if some order has both.
    An order's lines bound its pairs, so the join grows with the orders.  Some
    pairs are listed in both directions; some are in the older snapshot only.
    """
    p = read_table(spark, data_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    # Dealt once by (order, name): that serves the distinct lines and both sides of the join.
    li = (read_table(spark, data_dir, "lineitem").select("l_orderkey", "l_partkey")
          .join(p.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
          .dropna(subset=["l_orderkey", "p_name"]).repartition("l_orderkey", "p_name").distinct())
    a = li.select("l_orderkey", "p_name", F.col("l_partkey").alias("a"))
    b = li.select("l_orderkey", "p_name", F.col("l_partkey").alias("b"))
    pairs = a.join(b, ["l_orderkey", "p_name"]).filter("a < b").select("a", "b").distinct()
    pair, total = F.struct(F.col("a").alias("main_sku_id1"), F.col("b").alias("main_sku_id2")), F.col("a") + F.col("b")
    back = F.struct(F.col("b").alias("main_sku_id1"), F.col("a").alias("main_sku_id2"))
    dt = F.when(total % 7 == 0, F.lit(STALE_MATCH_DATE)).otherwise(F.lit(SIMILARITY_RUN_DATE)).alias("dt")
    both = pairs.select(dt, _rows(pair, F.when(total % 5 == 0, back)))
    for i in (1, 2):
        both = both.join(p.select(F.col("p_partkey").alias(f"main_sku_id{i}"), F.col("p_type").alias(f"cid3_{i}"),
                                  F.col("p_brand").alias(f"brand_code{i}"),
                                  F.concat(F.lit("Name of "), F.col("p_brand")).alias(f"brand_name{i}")), f"main_sku_id{i}")
    return both.select(*[f"{c}{i}" for i in (1, 2) for c in ("cid3_", "main_sku_id", "brand_code", "brand_name")], "dt")


def derive_sku_sales(spark: SparkSession, data_dir: str) -> DataFrame:
    """I8: daily SKU sales (cid3, brand_code, sku_id, gmv decimal, sale_qtty, dt).

    Some SKUs sell for the same sum every day; one brand has net returns in some categories.
    The lines are dealt once by SKU, which serves the sums and the join; a SKU's
    categories and brands meet its daily sums instead of its lines, each as often as ``part`` lists it.
    """
    lines = _dated_lines(spark, data_dir).dropna(subset=["l_partkey"]).repartition("l_partkey")
    sums = lines.groupBy("l_partkey", "dt").agg(F.sum("amount").alias("amount"), F.sum("qty").alias("qty"))
    p = (read_table(spark, data_dir, "part").groupBy("p_partkey", F.col("p_type").alias("cid3"), F.col("p_brand").alias("brand_code"))
         .agg(F.count(F.lit(1)).alias("times")))
    sold = (sums.join(p, sums.l_partkey == p.p_partkey)
                .select("cid3", "brand_code", F.col("l_partkey").alias("sku_id"), "dt",
                        (F.col("amount") * F.col("times")).cast(GMV_TYPE).alias("sum"), (F.col("qty") * F.col("times")).alias("sale_qtty")))
    total = F.when(F.col("sku_id") % 10 == 0, F.lit(500).cast("decimal(22,4)")).otherwise(F.col("sum"))
    returns = (F.col("brand_code") == "Brand#1") & (F.length("cid3") == 5)
    return sold.select("cid3", "brand_code", "sku_id", "dt",
                       F.when(returns, -F.abs(total)).otherwise(total).cast(GMV_TYPE).alias("gmv"), "sale_qtty")


def derive_declared_links(spark: SparkSession, data_dir: str) -> DataFrame:
    """Vendor-declared rival URLs (vender_id, similarity_url), some of them malformed."""
    s = read_table(spark, data_dir, "supplier")
    key = F.col("s_suppkey")
    url = F.concat(F.lit("https://shop"), ((key * 7 + 3) % 10).cast("string"), F.lit(".example.com/"))
    odd = (F.when(key % 13 == 1, F.lit("nocolon")).when(key % 13 == 2, F.lit("http://a:80/"))
           .when(key % 13 == 3, F.lit("")).when(key % 13 != 4, url))
    return s.select(key.alias("vender_id"), odd.alias("similarity_url"))


def derive_vendor_shops(spark: SparkSession, data_dir: str) -> DataFrame:
    """Vendor shops (vender_id, shop_url, dt); in the older snapshot each had its successor's URL."""
    s = read_table(spark, data_dir, "supplier")
    key = F.col("s_suppkey")

    def shop(k, dt):
        return F.struct(F.concat(F.lit("http://shop"), k.cast("string"), F.lit(".example.com")).alias("shop_url"),
                        F.lit(dt).alias("dt"))

    return s.select(key.alias("vender_id"), _rows(shop(key, SIMILARITY_RUN_DATE), shop(key + 1, STALE_MATCH_DATE)))


_STORE_ATTR = "_rivalry_inputs"
_STORE_LOCK = threading.RLock()  # queries may be built from several threads of one session


def _stored(name: str, derive, by_day: bool = False):
    """Derive input ``name`` once per session and data directory, store it, read it back.

    ``by_day`` inputs are stored partitioned by ``dt``, as their tables are.
    Without a checkpoint folder the derivation is used as it is; what fails
    while it is computed or stored fails the query.
    """

    @functools.wraps(derive)
    def load(spark: SparkSession, data_dir: str) -> DataFrame:
        with _STORE_LOCK:
            return _load(spark, data_dir)

    def _load(spark: SparkSession, data_dir: str) -> DataFrame:
        store = getattr(spark, _STORE_ATTR, None)
        if store is None:
            store = {}
            setattr(spark, _STORE_ATTR, store)
        key = (str(data_dir).rstrip("/"), name)
        if key not in store:
            derived, folder = derive(spark, data_dir), checkpoint_folder(spark)
            if folder is None:
                return derived
            tag = hashlib.sha1(key[0].encode()).hexdigest()[:12]
            path = f"{folder.rstrip('/')}/rivalry-inputs/{tag}/{name}"
            # A day's rows go to one task unless they are many: Spark splits a rebalanced partition that is large.
            writer = derived.hint("rebalance", F.col("dt")).write.partitionBy("dt") if by_day else derived.write
            writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
            store[key] = spark.read.schema(derived.schema).parquet(path)
        return store[key]

    load.__name__ = name
    load.__doc__ = derive.__doc__
    return load


sku_dim = _stored("sku_dim", derive_sku_dim, by_day=True)
order_det = _stored("order_det", derive_order_det)
sku_switch = _stored("sku_switch", derive_sku_switch, by_day=True)
sku_attrs = _stored("sku_attrs", derive_sku_attrs)
market_defs = _stored("market_defs", derive_market_defs, by_day=True)
clicks = _stored("clicks", derive_clicks, by_day=True)
sku_match = _stored("sku_match", derive_sku_match, by_day=True)
sku_sales = _stored("sku_sales", derive_sku_sales)
declared_links = _stored("declared_links", derive_declared_links)
vendor_shops = _stored("vendor_shops", derive_vendor_shops, by_day=True)
