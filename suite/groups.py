"""Joins, group statistics, distributions and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.functions.keyed import split_side
from hearthrate.operators import groups
from suite.registry import query, rounded, table


def located(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with nation and region: a listing with its neighbourhood and group."""
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    regions = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    customers = groups.attach_dimension(table(spark, sf, "customer"), nations, ["c_nationkey"])
    return groups.attach_dimension(customers, regions, ["n_regionkey"])


LOCATED = "FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey"


@query("dim_join", "J1 S4", f"SELECT c_custkey, n_name, r_name {LOCATED}")
def dim_join(spark: SparkSession, sf: str) -> DataFrame:
    return located(spark, sf).select("c_custkey", "n_name", "r_name")


# One nation is blanked out: rows without a group must get no mean.
_OPEN = f"SELECT c_custkey, NULLIF(n_name, 'NATION_3') AS n_name, r_name, c_acctbal {LOCATED}"


@query("group_avg_rows", "W4", f"""
WITH t AS ({_OPEN})
SELECT c_custkey, CASE WHEN n_name IS NOT NULL THEN round(avg(c_acctbal) OVER (PARTITION BY n_name), 6) END AS nation_avg,
       round(avg(c_acctbal) OVER (PARTITION BY r_name), 6) AS region_avg,
       CASE WHEN n_name IS NOT NULL THEN round((sum(c_acctbal) OVER (PARTITION BY n_name) - c_acctbal)
            / NULLIF(count(*) OVER (PARTITION BY n_name) - 1, 0), 6) END AS others_avg
FROM t
""")
def group_avg_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = located(spark, sf).withColumn("n_name", F.nullif(F.col("n_name"), F.lit("NATION_3")))
    out = groups.attach_group_mean(rows, "n_name", "c_acctbal", "nation_avg")
    out = groups.attach_group_mean(out, "r_name", "c_acctbal", "region_avg")
    out = groups.attach_group_mean(out, "n_name", "c_acctbal", "others_avg", exclude_self=True)
    return rounded(out.select("c_custkey", "nation_avg", "region_avg", "others_avg"), "nation_avg", "region_avg", "others_avg")


@query("group_medians", "A15 A17", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 6) AS median_l_extendedprice,
       round(quantile_cont(l_quantity, 0.5), 6) AS median_l_quantity, round(quantile_cont(l_discount, 0.5), 6) AS median_l_discount
FROM lineitem GROUP BY l_returnflag
""")
def group_medians(spark: SparkSession, sf: str) -> DataFrame:
    out = groups.group_medians(
        table(spark, sf, "lineitem"), "l_returnflag", ["l_extendedprice", "l_quantity", "l_discount"]
    )
    return rounded(out, "median_l_extendedprice", "median_l_quantity", "median_l_discount")


@query("small_sample_note", "A16", """
SELECT o_custkey, round(quantile_cont(o_totalprice, 0.5), 6) AS median_price, count(*) AS n,
       CASE WHEN count(*) < 10 THEN 'Note: small sample size may affect median' ELSE '' END AS note
FROM orders GROUP BY o_custkey
""")
def small_sample_note(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(groups.group_price_table(table(spark, sf, "orders"), "o_custkey", "o_totalprice"), "median_price")


@query("group_median_sorted", "A17", """
SELECT p_brand, round(quantile_cont(p_retailprice, 0.5), 6) AS median_price FROM part GROUP BY p_brand
""")
def group_median_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(groups.group_median_sorted(table(spark, sf, "part"), "p_brand", "p_retailprice"), "median_price")


@query("top_bottom_groups", "A18 O5", """
WITH m AS (SELECT l_suppkey, avg(l_extendedprice) AS mean_value FROM lineitem GROUP BY l_suppkey)
SELECT 'top' AS side, l_suppkey, round(mean_value, 5) AS mean_value FROM (SELECT * FROM m ORDER BY mean_value DESC, l_suppkey LIMIT 10)
UNION ALL
SELECT 'bottom', l_suppkey, round(mean_value, 5) FROM (SELECT * FROM m ORDER BY mean_value, l_suppkey LIMIT 10)
""")
def top_bottom_groups(spark: SparkSession, sf: str) -> DataFrame:
    out = groups.top_bottom_groups(table(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice")
    return rounded(out, "mean_value", digits=5)


@query("group_mean_sentiment", "A19", """
SELECT event_type, round(avg((value - 50) / 50), 6) AS mean_value FROM events GROUP BY event_type
""")
def group_mean_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    scored = table(spark, sf, "events").select("event_type", ((F.col("value") - 50) / 50).alias("s"))
    return rounded(groups.group_mean(scored, "event_type", "s"), "mean_value")


@query("value_counts", "A20", "SELECT NULLIF(p_type, 'ECONOMY') AS p_type, count(*) AS n FROM part GROUP BY 1")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("p_type"))
    return groups.value_counts(part, "p_type")


@query("distinct_keys", "A21", """
SELECT l_suppkey, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS parts FROM (SELECT DISTINCT l_suppkey FROM lineitem)
""")
def distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    parts = groups.distinct_keys(lines, "l_partkey").agg(F.count(F.lit(1)))
    return groups.distinct_keys(lines, "l_suppkey").withColumn("parts", parts.scalar())


@query("box_stats", "A22", """
WITH v AS (SELECT l_returnflag, l_extendedprice * l_quantity AS v FROM lineitem),
q AS (SELECT l_returnflag, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM v GROUP BY 1),
b AS (SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM v JOIN q USING (l_returnflag))
SELECT l_returnflag, count(*) AS n, round(max(q1), 4) AS q1, round(max(median), 4) AS median, round(max(q3), 4) AS q3,
       round(min(CASE WHEN inside THEN v END), 4) AS whisker_low, round(max(CASE WHEN inside THEN v END), 4) AS whisker_high,
       count(CASE WHEN NOT inside THEN 1 END) AS outliers
FROM b GROUP BY l_returnflag
""")
def box_stats(spark: SparkSession, sf: str) -> DataFrame:
    values = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_extendedprice") * F.col("l_quantity")).alias("v"))
    return rounded(groups.box_stats(values, "l_returnflag", "v"), "q1", "median", "q3", "whisker_low", "whisker_high", digits=4)


@query("histogram", "A23", """
WITH s AS (SELECT CASE WHEN substr(md5('42|' || o_orderkey::VARCHAR), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS side,
                  o_totalprice / 1000.0 AS price FROM orders),
h AS (SELECT side, least(floor(price / 10.0), 48)::INTEGER AS bin, count(*) AS n FROM s WHERE price BETWEEN 0 AND 490 GROUP BY 1, 2)
SELECT side, bin, bin * 10.0::DOUBLE AS bin_low, (bin + 1) * 10.0::DOUBLE AS bin_high, n,
       n / (sum(n) OVER (PARTITION BY side) * 10.0::DOUBLE) AS density
FROM h
""")
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    prices = table(spark, sf, "orders").select(
        split_side(F.col("o_orderkey")).alias("side"), (F.col("o_totalprice") / 1000.0).alias("price")
    )
    return groups.histogram(prices, "price", 0.0, 490.0, 49, ["side"])


@query("histogram_full_range", "A23", """
WITH e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
h AS (SELECT least(floor((l_quantity - lo) / ((hi - lo) / 40)), 39)::INTEGER AS bin, count(*) AS n FROM lineitem, e GROUP BY 1)
SELECT bin, round(lo + bin * ((hi - lo) / 40), 9) AS bin_low, round(lo + (bin + 1) * ((hi - lo) / 40), 9) AS bin_high, n,
       round(n / ((SELECT sum(n) FROM h) * ((hi - lo) / 40)), 9) AS density
FROM h, e
""")
def histogram_full_range(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(groups.equal_width_histogram(table(spark, sf, "lineitem"), "l_quantity", 40), "bin_low", "bin_high", "density", digits=9)


@query("union_batches", "U1", """
SELECT priority, count(*) AS n, round(sum(amount), 4) AS amount FROM (
  SELECT o_orderpriority AS priority, o_totalprice AS amount FROM orders
  UNION ALL SELECT c_mktsegment, c_acctbal FROM customer) GROUP BY priority
""")
def union_batches(spark: SparkSession, sf: str) -> DataFrame:
    first = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("amount"))
    second = table(spark, sf, "customer").select(F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("priority"))
    merged = groups.union_batches([first, second])
    return merged.groupBy("priority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 4).alias("amount"))


@query("group_except", "U2 J6", """
WITH late AS (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-01-01')
SELECT c_custkey, c_nationkey, 'never' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM late)
UNION ALL SELECT c_custkey, c_nationkey, 'late' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM late)
""")
def group_except(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    late = table(spark, sf, "orders").where(F.col("o_orderdate") >= "2001-01-01").select(F.col("o_custkey").alias("c_custkey"))
    absent = groups.missing_groups(customers, late, "c_custkey").join(customers, "c_custkey")
    present = groups.keep_members(customers, late, "c_custkey")
    return absent.withColumn("side", F.lit("never")).unionByName(present.withColumn("side", F.lit("late")))


@query("align_to_keys", "J4", """
SELECT s_suppkey, coalesce(n, 0) AS n, coalesce(total, 0.0) AS total FROM supplier
LEFT JOIN (SELECT l_suppkey, count(*) AS n, round(sum(l_quantity), 4) AS total FROM lineitem WHERE l_discount = 0.1 AND l_tax = 0.08
           AND l_quantity > 30 GROUP BY l_suppkey) ON l_suppkey = s_suppkey
""")
def align_to_keys(spark: SparkSession, sf: str) -> DataFrame:
    strict = (F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08) & (F.col("l_quantity") > 30)
    counts = table(spark, sf, "lineitem").where(strict).groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("total")
    )
    return groups.align_to_keys(table(spark, sf, "supplier").select("s_suppkey"), counts, "s_suppkey", {"n": 0, "total": 0.0})
