"""Readers, writers and the run log, over data written from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.functions.pricing import CAPPED_CLIP
from hearthrate.operators.design import DesignMatrix
from hearthrate.operators.groups import group_price_table
from hearthrate.operators.models import linear
from hearthrate.operators.scoring import score_listings
from hearthrate.session import scratch_path
from hearthrate.sources import artifacts, runs, tables
from suite.groups import located
from suite.registry import query, rounded, table
from suite.residuals import PREDICTED, results


@query("csv_scan", "S1 S2 K1", """
SELECT doc_id, text, lang, (DATE '2020-01-01' + (doc_id % 1000)::INTEGER)::VARCHAR AS day FROM documents
""")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their line breaks through CSV: written whole, read back pruned and parsed."""
    path = scratch_path(spark, "documents")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 1000).cast("int")).cast("string")
    tables.write_delimited(table(spark, sf, "documents").withColumn("day", day), path)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, day string"
    back = tables.read_delimited(spark, path, schema, ["doc_id", "text", "lang", "day"], ["day"])
    return back.withColumn("day", F.col("day").cast("string"))


@query("csv_inferred", "S1 S3 S4", """
SELECT id, price, area FROM (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice END AS price, o_orderstatus AS area FROM orders)
WHERE price IS NOT NULL
""")
def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 8 != 0, F.col("o_totalprice")).alias("price"), "o_orderstatus"
    )
    tables.write_delimited(orders, path)
    back = tables.read_delimited(spark, path).withColumnRenamed("o_orderstatus", "area")
    return back.select(F.col("id").cast("bigint").alias("id"), "price", "area").where(F.col("price").isNotNull())


@query("polygon_prices", "S5 J7 A16", """
SELECT n_name AS neighbourhood, round(quantile_cont(c_acctbal, 0.5), 6) AS median_price, count(c_acctbal) AS n
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name
""")
def polygon_prices(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "polygons")
    tables.write_polygons(table(spark, sf, "nation"), "n_name", path)
    prices = group_price_table(located(spark, sf), "n_name", "c_acctbal").withColumnRenamed("n_name", "neighbourhood")
    joined = tables.polygon_values(tables.read_polygon_names(spark, path), prices, "neighbourhood")
    return rounded(joined.select("neighbourhood", "median_price", F.coalesce("n", F.lit(0)).alias("n")), "median_price")


_FACTORS = {"plain": 1.0, "raised": 1.1, "lowered": 0.85}


def measured_runs(spark: SparkSession, sf: str) -> list[DataFrame]:
    rows = results(spark, sf)
    out = []
    for name, factor in _FACTORS.items():
        error = F.col("predicted") * factor - F.col("actual")
        measured = rows.agg(
            F.round(F.avg(F.abs(error)), 4).alias("test_mae"), F.round(F.sqrt(F.avg(error * error)), 4).alias("test_rmse")
        ).first().asDict()
        tags = {"production": "true"} if name == "plain" else {}
        out.append(runs.run_rows(spark, name, {"model_name": f"model {name}"}, measured, tags))
    return out


_RUNS_SQL = "WITH " + PREDICTED + ", r AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS run_id, round(avg(abs(predicted * {f} - actual)), 4) AS test_mae, "
    f"round(sqrt(avg((predicted * {f} - actual) * (predicted * {f} - actual))), 4) AS test_rmse FROM res"
    for name, f in _FACTORS.items()
) + """)
SELECT run_id, test_mae, test_rmse, 'model ' || run_id AS model_name, (run_id = 'plain')::INTEGER AS production FROM r
"""


@query("runs_summary", "K5 R11", _RUNS_SQL)
def runs_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs measured on the orders, appended to the log and read back."""
    path = scratch_path(spark, "runs")
    for run in measured_runs(spark, sf):
        runs.append_runs(run, path)
    return runs.run_summary(runs.read_runs(spark, path), ["test_mae", "test_rmse"])


@query("run_files", "S7 R11", _RUNS_SQL)
def run_files(spark: SparkSession, sf: str) -> DataFrame:
    """The same runs as one small file per entry, scanned and summarised."""
    path = scratch_path(spark, "run-files")
    for run in measured_runs(spark, sf):
        runs.write_run_files(run, path, at_ms=1_700_000_000_000)
    return runs.run_summary(runs.scan_run_files(spark, path), ["test_mae", "test_rmse"])


@query("artifact_scores", "K3 G5", """
WITH t AS (SELECT o_orderkey AS id, o_totalprice / 900.0 AS price, o_custkey::DOUBLE AS accommodates FROM orders),
f AS (SELECT regr_slope(ln(price), accommodates) AS b, regr_intercept(ln(price), accommodates) AS a FROM t)
SELECT id, round_even(exp(least(greatest(a + b * accommodates, ln(1.0)), ln(1000.0))), 2) AS predicted_price, 'LOW' AS confidence_tier FROM t, f
""")
def artifact_scores(spark: SparkSession, sf: str) -> DataFrame:
    """A model saved with its design, loaded again and applied; listings without review data score LOW."""
    listings = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 900.0).alias("price"), F.col("o_custkey").cast("double").alias("accommodates")
    )
    fitted = DesignMatrix.fit(listings)
    path = scratch_path(spark, "artifact")
    artifacts.save_artifact(spark, path, linear().fit(fitted.assemble(listings)), fitted, price_cap=500)
    model, design, _ = artifacts.load_artifact(spark, path)
    return score_listings(listings, design, model, CAPPED_CLIP).select("id", "predicted_price", "confidence_tier")
