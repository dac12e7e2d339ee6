"""Profiling reports and the quality gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.operators import profile, quality
from hearthrate.operators.impute import fill_with_medians
from suite.registry import query, rounded, table

NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
# Cells blanked out by key, since the driver tables hold no nulls.
GAPS_SQL = """
SELECT o_orderkey,
       CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 5 < 3 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""
GAP_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def orders_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(key % 3 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 11 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(key % 5 >= 3, F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def per_column(columns, piece: str, source: str = "lineitem") -> str:
    return " UNION ALL ".join(f"SELECT {piece.format(c=c)} FROM {source}" for c in columns)


@query("missing_report", "P4 P14", f"WITH g AS ({GAPS_SQL}) SELECT * FROM (" + per_column(
    GAP_COLUMNS,
    "'{c}' AS \"column\", count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100.0 / count(*), 2) AS pct",
    "g") + ") WHERE missing > 0")
def missing_report(spark: SparkSession, sf: str) -> DataFrame:
    return profile.missing_report(orders_with_gaps(spark, sf))


@query("missing_before_after", "P14 N3", f"""
WITH g AS ({GAPS_SQL})
SELECT sum(m)::BIGINT AS cells_before, count(CASE WHEN m > 0 THEN 1 END) AS columns_before,
       sum(CASE WHEN c IN ('o_custkey', 'o_totalprice') THEN 0 ELSE m END)::BIGINT AS cells_after,
       count(CASE WHEN m > 0 AND c NOT IN ('o_custkey', 'o_totalprice') THEN 1 END) AS columns_after
FROM ({per_column(GAP_COLUMNS, "'{c}' AS c, count(*) - count({c}) AS m", "g")})
""")
def missing_before_after(spark: SparkSession, sf: str) -> DataFrame:
    gaps = orders_with_gaps(spark, sf)
    filled = fill_with_medians(gaps, ["o_custkey", "o_totalprice"])
    before, after = profile.missing_totals(gaps), profile.missing_totals(filled)
    return before.select(
        F.col("missing_cells").alias("cells_before"), F.col("columns_with_missing").alias("columns_before")
    ).withColumns({
        "cells_after": after.select("missing_cells").scalar(),
        "columns_after": after.select("columns_with_missing").scalar(),
    })


@query("numeric_summary", "P3", "SELECT * FROM (" + per_column(
    NUMBERS,
    "'{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max",
) + ")")
def numeric_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.numeric_summary(table(spark, sf, "lineitem"), NUMBERS), "mean", "std")


@query("table_shape", "P1", "SELECT count(*) AS \"rows\", 11 AS columns FROM lineitem")
def table_shape(spark: SparkSession, sf: str) -> DataFrame:
    return profile.inspect(table(spark, sf, "lineitem"))["shape"]


@query("inspect_report", "P5", "SELECT 'shape' AS part, 'lineitem' AS \"column\", count(*)::DOUBLE AS a, 11.0::DOUBLE AS b FROM lineitem UNION ALL SELECT * FROM (" + per_column(
    NUMBERS, "'summary' AS part, '{c}' AS \"column\", round(avg({c}), 6)::DOUBLE AS a, round(stddev_samp({c}), 6)::DOUBLE AS b") + ")")
def inspect_report(spark: SparkSession, sf: str) -> DataFrame:
    """All three parts of one inspection; the table has no gaps, so the last adds no row."""
    found = profile.inspect(table(spark, sf, "lineitem"))
    value = lambda c: F.col(c).cast("double")
    shape = found["shape"].select(F.lit("shape").alias("part"), F.lit("lineitem").alias("column"), value("rows").alias("a"), value("columns").alias("b"))
    summary = found["summary"].where(F.col("column").isin(*NUMBERS)).select(F.lit("summary"), "column", F.round("mean", 6), F.round("std", 6))
    missing = found["missing"].select(F.lit("missing"), "column", value("missing"), value("pct"))
    return shape.union(summary).union(missing)


@query("describe_numeric", "P6", "SELECT * FROM (" + per_column(
    NUMBERS,
    "'{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    "min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    "round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max",
) + ")")
def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.describe_numeric(table(spark, sf, "lineitem"), NUMBERS), "mean", "std", "p25", "p50", "p75")


_TARGET = "round(avg({e}), 4) AS mean, round(quantile_cont({e}, 0.5), 4) AS median, round(stddev_samp({e}), 4) AS std, " \
    "round(min({e}), 4) AS min, round(quantile_cont({e}, 0.25), 4) AS p25, round(quantile_cont({e}, 0.75), 4) AS p75, " \
    "round(max({e}), 4) AS max, round(skewness({e}), 4) AS skew FROM orders"


@query("target_stats", "P7", "SELECT 'raw' AS scale, " + _TARGET.format(e="o_totalprice")
       + " UNION ALL SELECT 'log' AS scale, " + _TARGET.format(e="ln(o_totalprice)"))
def target_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.target_summary(table(spark, sf, "orders"), "o_totalprice")
    return rounded(out, "mean", "median", "std", "min", "p25", "p75", "max", "skew", digits=4)


@query("coverage_report", "P8", f"WITH g AS ({GAPS_SQL}) " + per_column(
    ("o_custkey", "o_totalprice"),
    "'{c}' AS \"column\", count({c}) AS filled, round(count({c}) * 100.0 / count(*), 6) AS pct, min({c})::DOUBLE AS min, "
    "round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median, max({c})::DOUBLE AS max", "g"))
def coverage_report(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.coverage_report(orders_with_gaps(spark, sf), ["o_custkey", "o_totalprice"])
    return rounded(out, "pct", "median")


@query("corr_with_target", "P10", "SELECT * FROM (" + per_column(
    ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey"),
    "'{c}' AS \"column\", round(corr({c}, l_extendedprice), 6) AS r, "
    "CASE WHEN corr({c}, l_extendedprice) > 0 THEN 'higher' ELSE 'lower' END AS direction",
) + ")")
def corr_with_target(spark: SparkSession, sf: str) -> DataFrame:
    names = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]
    return rounded(profile.target_correlations(table(spark, sf, "lineitem"), "l_extendedprice", names), "r")


_PAIRS = [(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i:]]


@query("corr_matrix", "P11", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in _PAIRS))
def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.correlation_matrix(table(spark, sf, "lineitem"), NUMBERS), "r")


_CANDIDATES = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")


@query("top_corr_matrix", "P12", "WITH r AS (" + per_column(
    _CANDIDATES, "'{c}' AS name, abs(corr({c}, l_extendedprice)) AS strength")
    + "), top AS (SELECT name, row_number() OVER (ORDER BY strength DESC, name) AS k FROM r QUALIFY k <= 3), pairs AS ("
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem"
                         for a in _CANDIDATES for b in _CANDIDATES)
    + ") SELECT a, b, round(r, 6) AS r FROM pairs JOIN top x ON x.name = a JOIN top y ON y.name = b AND x.k <= y.k")
def top_corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*_CANDIDATES, "l_extendedprice")
    return rounded(profile.top_correlated_matrix(lines, "l_extendedprice", top=3), "r")


@query("null_matrix", "P15 O6", f"""
WITH g AS ({GAPS_SQL}),
s AS (SELECT * FROM g ORDER BY md5('42|' || o_orderkey::VARCHAR), o_orderkey LIMIT 300)
SELECT o_orderkey, (o_custkey IS NULL)::INTEGER AS o_custkey, (o_orderstatus IS NULL)::INTEGER AS o_orderstatus,
       (o_totalprice IS NULL)::INTEGER AS o_totalprice, (o_orderpriority IS NULL)::INTEGER AS o_orderpriority
FROM s
""")
def null_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_matrix(orders_with_gaps(spark, sf), "o_orderkey", 300)


@query("quality_report", "Q1 Q2 Q3 Q4 Q5 Q6 Q7", """
WITH t AS (
  SELECT o_orderkey AS order_count, o_totalprice / 1000.0 AS rate,
         CASE WHEN o_orderkey % 5 < 3 THEN NULL ELSE o_orderpriority END AS priority,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS status,
         7 AS constant,
         CASE WHEN o_orderkey = 0 THEN 1e7 ELSE (o_custkey % 10) END::DOUBLE AS spike
  FROM orders),
s AS (SELECT count(*) AS n FROM t),
c AS (SELECT status, count(*) * 100.0 / (SELECT n FROM s) AS pct FROM t GROUP BY status)
SELECT 'schema' AS "check", 'absent' AS "column", 'failure' AS severity, NULL::DOUBLE AS value
UNION ALL SELECT 'schema', 'status', 'warning', NULL
UNION ALL SELECT 'nulls', 'priority', 'failure', round(count(CASE WHEN priority IS NULL THEN 1 END) * 100.0 / count(*), 6) FROM t
UNION ALL SELECT 'nulls', 'status', 'warning', round(count(CASE WHEN status IS NULL THEN 1 END) * 100.0 / count(*), 6) FROM t
UNION ALL SELECT 'range', 'rate', 'warning', round(max(rate), 6) FROM t
UNION ALL SELECT 'variance', 'constant', 'warning', 7.0
UNION ALL SELECT 'outliers', 'spike', 'warning', round((max(spike) - avg(spike)) / stddev_samp(spike), 6) FROM t
UNION ALL SELECT 'target', 'status', 'warning', count(*)::DOUBLE FROM c WHERE pct < 5 HAVING count(*) > 0
""")
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(
        key.alias("order_count"), (F.col("o_totalprice") / 1000.0).alias("rate"),
        F.when(key % 5 >= 3, F.col("o_orderpriority")).alias("priority"),
        F.when(key % 4 != 0, F.col("o_orderstatus")).alias("status"),
        F.lit(7).alias("constant"),
        F.when(key == 0, 1e7).otherwise((F.col("o_custkey") % 10).cast("double")).alias("spike"),
    )
    report = quality.quality_report(orders, {"absent": "int", "status": "double", "rate": "double"}, "status")
    return report.select("check", "column", "severity", F.round("value", 6).alias("value"))


@query("quality_verdict", "Q7", """
SELECT 1 AS passed, 0::BIGINT AS failures,
       (1 + (SELECT count(*) < 1000 FROM customer)::INTEGER + (SELECT count(*) > 0 FROM (
          SELECT c_mktsegment FROM customer GROUP BY 1 HAVING count(*) * 100.0 / (SELECT count(*) FROM customer) < 5
       ))::INTEGER)::BIGINT AS warnings
""")
def quality_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return quality.gate_verdict(quality.quality_report(table(spark, sf, "customer"), None, "c_mktsegment"))


@query("class_balance", "Q6 A20", """
SELECT CAST(quality AS VARCHAR) AS class, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM labels), 6) AS pct,
       (count(*) * 100.0 / (SELECT count(*) FROM labels) < 5)::INTEGER AS below_min
FROM labels GROUP BY quality
""")
def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    counts = quality.class_table(table(spark, sf, "labels"), "quality")
    return rounded(counts, "pct")


@query("quality_gate_strict", "Q8", f"""
WITH g AS ({GAPS_SQL})
SELECT 'missing_column' AS "check", 'room_type' AS detail
UNION ALL SELECT 'target_has_nulls', 'o_totalprice'
UNION ALL SELECT 'null_rate', 'o_orderpriority' FROM g HAVING count(o_orderpriority) < 0.6 * count(*)
""")
def quality_gate_strict(spark: SparkSession, sf: str) -> DataFrame:
    return quality.strict_gate(
        orders_with_gaps(spark, sf), ["o_orderkey", "o_totalprice", "room_type"], "o_totalprice"
    )


@query("table_statistics", "Q7", f"""
WITH g AS ({GAPS_SQL})
SELECT max(n) AS "rows", count(*) AS columns, 3::BIGINT AS numeric_columns, sum(m)::BIGINT AS null_cells
FROM ({per_column(GAP_COLUMNS, "count(*) AS n, count(*) - count({c}) AS m", "g")})
""")
def table_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return quality.table_statistics(orders_with_gaps(spark, sf))


@query("sentiment_summary", "P16", """
WITH s AS (SELECT (value - 50) / 50 AS score FROM events)
SELECT count(*) AS "rows", round(avg(score), 6) AS mean, round(quantile_cont(score, 0.5), 6) AS median,
       round(avg((score > 0.05)::INTEGER) * 100, 6) AS pct_positive,
       round(avg((score < -0.05)::INTEGER) * 100, 6) AS pct_negative
FROM s WHERE score <> 0
""")
def sentiment_summary(spark: SparkSession, sf: str) -> DataFrame:
    scores = table(spark, sf, "events").select(((F.col("value") - 50) / 50).alias("score"))
    return rounded(profile.sentiment_summary(scores, "score"), "mean", "median", "pct_positive", "pct_negative")
