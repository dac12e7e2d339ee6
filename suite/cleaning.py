"""Cleaning and column clipping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.operators.clean import (
    cap_price, cap_report, clean_listings, clip_at_quantile, clip_symmetric, keep_below_quantile, positive_price,
)
from hearthrate.operators.quality import REQUIRED_COLUMNS, STRICT_NULL_RATE, STRICT_ROWS
from hearthrate.plans.flows import clean_and_gate
from hearthrate.session import scratch_path
from suite.registry import query, rounded, table


def raw_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a raw export: prices as text, some missing or unreadable, some rows twice."""
    text = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    price = F.when(F.col("o_orderkey") % 17 == 0, None).when(F.col("o_orderkey") % 19 == 0, "abc").otherwise(text)
    once = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), price.alias("price"),
        F.lit(None).cast("string").alias("calendar_updated"),
    )
    return once.unionByName(once.where(F.col("status") == "F"))


RAW_SQL = """
WITH once AS (
  SELECT o_orderkey AS id, o_orderstatus AS status,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'abc'
              ELSE format('${:,.2f}', o_totalprice) END AS price
  FROM orders),
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE status = 'F'),
clean AS (
  SELECT DISTINCT id, status, TRY_CAST(trim(regexp_replace(price, '[$,]', '', 'g')) AS DOUBLE) AS price
  FROM raw WHERE price IS NOT NULL)
"""


@query("clean_prices", "C1 C2 C3 C4 C5", RAW_SQL + "SELECT id, status, price FROM clean")
def clean_prices(spark: SparkSession, sf: str) -> DataFrame:
    return clean_listings(raw_listings(spark, sf)).table


@query("clean_gate", "C5 Q8", RAW_SQL + f""",
n AS (SELECT count(*) AS n, count(price) AS priced, count(status) AS status FROM clean),
req(c) AS (VALUES {", ".join(f"('{c}')" for c in REQUIRED_COLUMNS)})
SELECT 'missing_column' AS "check", c AS detail FROM req WHERE c NOT IN ('id', 'status', 'price')
UNION ALL SELECT 'too_few_rows', n::VARCHAR FROM n WHERE n < {STRICT_ROWS}
UNION ALL SELECT 'target_has_nulls', 'price' FROM n WHERE priced < n
UNION ALL SELECT 'null_rate', 'price' FROM n WHERE (n - priced) / n > {STRICT_NULL_RATE}
UNION ALL SELECT 'rows_raw', count(*)::VARCHAR FROM raw
UNION ALL SELECT 'rows_priced', count(*)::VARCHAR FROM raw WHERE price IS NOT NULL
UNION ALL SELECT 'rows_distinct', n::VARCHAR FROM n
""")
def clean_gate(spark: SparkSession, sf: str) -> DataFrame:
    """What the gate finds in the listings being cleaned, and the rows that each step of the cleaning saw."""
    _, failures, steps = clean_and_gate(raw_listings(spark, sf), scratch_path(spark, "clean"))
    counts = spark.createDataFrame([(f"rows_{k}", str(v)) for k, v in steps.items()], "check string, detail string")
    return failures.unionByName(counts)


@query("price_cap", "C7 C8", """
WITH p AS (SELECT o_orderstatus AS status, o_totalprice / 900.0 AS price FROM orders),
t AS (SELECT count(*) AS total, count(CASE WHEN price <= 500 THEN 1 END) AS kept FROM p)
SELECT status, count(*) AS n, (SELECT total FROM t) AS total, (SELECT total - kept FROM t) AS removed,
       (SELECT (total - kept) * 100.0 / total FROM t) AS pct_removed
FROM p WHERE price <= 500 AND price > 0 GROUP BY status
""")
def price_cap(spark: SparkSession, sf: str) -> DataFrame:
    priced = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("status"), (F.col("o_totalprice") / 900.0).alias("price")
    )
    report = cap_report(priced)
    kept = positive_price(cap_price(priced)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return kept.withColumns({
        "total": report.select("rows").scalar(),
        "removed": report.select("removed").scalar(),
        "pct_removed": report.select("pct_removed").scalar(),
    })


@query("clip_outliers", "C11", """
WITH e AS (SELECT l_returnflag, l_extendedprice AS price, l_extendedprice - 1000 * l_quantity AS error FROM lineitem),
c AS (SELECT quantile_cont(price, 0.99) AS p, quantile_cont(abs(error), 0.99) AS m FROM e)
SELECT l_returnflag, count(*) AS n,
       round(max(least(price, p)), 6) AS highest,
       round(avg(least(price, p)), 6) AS mean_price,
       round(min(greatest(least(error, m), -m)), 6) AS lowest_error,
       round(avg(greatest(least(error, m), -m)), 6) AS mean_error,
       count(CASE WHEN price <= p THEN 1 END) AS below_cut
FROM e, c GROUP BY l_returnflag
""")
def clip_outliers(spark: SparkSession, sf: str) -> DataFrame:
    errors = table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") - 1000 * F.col("l_quantity")).alias("error"),
    )
    clipped = clip_symmetric(clip_at_quantile(errors, "price", out="clipped"), "error")
    below = keep_below_quantile(errors, "price").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("below_cut"))
    out = clipped.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.max("clipped").alias("highest"), F.avg("clipped").alias("mean_price"),
        F.min("error").alias("lowest_error"), F.avg("error").alias("mean_error"),
    )
    return rounded(out.join(below, "l_returnflag"), "highest", "mean_price", "lowest_error", "mean_error")
