"""Soundness of splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.functions.keyed import split_side
from hearthrate.operators import validation
from suite.registry import query, rounded, table

SIDE = "CASE WHEN substr(md5('42|' || o_orderkey::VARCHAR), 1, 8) < '33333333' THEN 'test' ELSE 'train' END"
_KS = f"""
WITH s AS (SELECT {SIDE} AS side, o_totalprice, o_custkey::DOUBLE AS o_custkey FROM orders),
l AS (SELECT 'o_totalprice' AS "column", side, o_totalprice AS v FROM s UNION ALL SELECT 'o_custkey', side, o_custkey FROM s),
c AS (SELECT "column", v, count(CASE WHEN side = 'train' THEN 1 END) AS one, count(CASE WHEN side = 'test' THEN 1 END) AS two FROM l GROUP BY 1, 2),
u AS (SELECT "column", sum(one) OVER w AS a, sum(two) OVER w AS b, sum(one) OVER (PARTITION BY "column") AS n1, sum(two) OVER (PARTITION BY "column") AS n2
      FROM c WINDOW w AS (PARTITION BY "column" ORDER BY v)),
d AS (SELECT "column", max(n1)::BIGINT AS n1, max(n2)::BIGINT AS n2, max(abs(a / n1 - b / n2)) AS statistic FROM u GROUP BY "column"),
z AS (SELECT *, (sqrt(n1::DOUBLE * n2 / (n1 + n2)) + 0.12 + 0.11 / sqrt(n1::DOUBLE * n2 / (n1 + n2))) * statistic AS reach FROM d),
p AS (SELECT "column", n1, n2, statistic, least(greatest(sum((CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * reach * reach)), 0.0), 1.0) AS p_value
      FROM z, range(1, 101) r(k) GROUP BY ALL)
"""


def split_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("side", split_side(F.col("o_orderkey")))


@query("ks_two_sample", "V1 V2", _KS + """
SELECT "column", n1, n2, round(statistic, 9) AS statistic, round(p_value, 6) AS p_value, (p_value > 0.05)::INTEGER AS passed FROM p
""")
def ks_two_sample(spark: SparkSession, sf: str) -> DataFrame:
    out = validation.ks_two_sample(split_orders(spark, sf), ["o_totalprice", "o_custkey"], "side")
    return rounded(rounded(out, "statistic", digits=9), "p_value")


@query("ks_all_pass", "V2", _KS + "SELECT min((p_value > 0.05)::INTEGER) AS passed, count(*) AS checks FROM p")
def ks_all_pass(spark: SparkSession, sf: str) -> DataFrame:
    return validation.all_passed(validation.ks_two_sample(split_orders(spark, sf), ["o_totalprice", "o_custkey"], "side"))


@query("representation", "V3 U2", f"""
WITH s AS (SELECT o_custkey, {SIDE} AS side FROM orders)
SELECT o_custkey, count(CASE WHEN side = 'train' THEN 1 END) AS train, count(CASE WHEN side = 'test' THEN 1 END) AS test,
       (count(CASE WHEN side = 'train' THEN 1 END) = 0 OR count(CASE WHEN side = 'test' THEN 1 END) = 0)::INTEGER AS missing
FROM s GROUP BY o_custkey
""")
def representation(spark: SparkSession, sf: str) -> DataFrame:
    return validation.representation(split_orders(spark, sf), "o_custkey", "side")
