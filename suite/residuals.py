"""Residual analysis of a formula predictor over the orders."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.functions.pricing import OPEN_EDGES, OPEN_LABELS, price_bucket
from hearthrate.operators import residuals
from hearthrate.session import settle
from suite.registry import query, rounded, table

PREDICTED = """
pred AS (SELECT o_orderkey AS id, o_custkey, o_orderpriority, o_totalprice / 900.0 AS actual,
                (o_totalprice / 900.0) * (0.75 + (o_custkey % 101) / 200.0) AS predicted FROM orders),
res AS (SELECT *, predicted - actual AS error, abs(predicted - actual) AS abs_error,
               abs(predicted - actual) * 100 / actual AS pct_error,
               CASE WHEN actual < 100 THEN '$0–100' WHEN actual < 200 THEN '$100–200' WHEN actual < 500 THEN '$200–500' END AS bucket,
               CASE WHEN actual < 100 THEN '$0–100' WHEN actual < 200 THEN '$100–200' WHEN actual < 500 THEN '$200–500' ELSE '$500+' END AS open_bucket
        FROM pred)
"""


def results(spark: SparkSession, sf: str) -> DataFrame:
    actual = F.col("o_totalprice") / 900.0
    pred = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), "o_custkey", "o_orderpriority", actual.alias("actual"),
        (actual * (0.75 + (F.col("o_custkey") % 101) / 200.0)).alias("predicted"),
    )
    return residuals.error_columns(pred).withColumns({
        "bucket": price_bucket(F.col("actual")),
        "open_bucket": price_bucket(F.col("actual"), OPEN_EDGES, OPEN_LABELS),
    })


@query("results_frame", "E3 E4", "WITH " + PREDICTED + """
SELECT id, round(actual, 7) AS actual, round(predicted, 7) AS predicted, round(error, 7) AS error,
       round(abs_error, 7) AS abs_error, round(pct_error, 7) AS pct_error, bucket FROM res
""")
def results_frame(spark: SparkSession, sf: str) -> DataFrame:
    logs = results(spark, sf).select("id", F.ln("actual").alias("label"), F.ln("predicted").alias("prediction"))
    frame = residuals.results_frame(logs, clip=None).select(
        "id", "actual", "predicted", "error", "abs_error", "pct_error", "bucket"
    )
    return rounded(frame, "actual", "predicted", "error", "abs_error", "pct_error", digits=7)


@query("dollar_metrics", "E1 E2", "WITH " + PREDICTED + """,
m AS (SELECT o_orderpriority, ln(actual) AS label, ln(predicted) AS prediction, actual, least(greatest(predicted, 1.0), 400000.0) AS p FROM res)
SELECT o_orderpriority, count(*) AS n, round(avg(abs(actual - p)), 5) AS mae, round(sqrt(avg((actual - p) * (actual - p))), 5) AS rmse,
       round(1 - sum((actual - p) * (actual - p)) / (var_pop(actual) * count(*)), 5) AS r2,
       round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 5) AS r2_log
FROM m GROUP BY o_orderpriority
""")
def dollar_metrics(spark: SparkSession, sf: str) -> DataFrame:
    import math

    logs = results(spark, sf).select("o_orderpriority", F.ln("actual").alias("label"), F.ln("predicted").alias("prediction"))
    clip = (0.0, math.log(400_000))
    return rounded(
        residuals.dollar_metrics(logs, clip=clip, groups=["o_orderpriority"]), "mae", "rmse", "r2", "r2_log", digits=5
    )


@query("error_buckets", "E4 E5 E9", "WITH " + PREDICTED + """
SELECT open_bucket, count(*) AS n, round(avg(abs_error), 5) AS mae, round(avg(pct_error), 5) AS mape,
       round(quantile_cont(abs_error, 0.5), 5) AS median_error, round(avg(error), 5) AS bias,
       CASE WHEN avg(error) >= 0 THEN 'over' ELSE 'under' END AS direction
FROM res GROUP BY open_bucket
""")
def error_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(residuals.bucket_errors(results(spark, sf), "open_bucket"), "mae", "mape", "median_error", "bias", digits=5)


@query("bucket_deltas", "R12 E5", "WITH " + PREDICTED + """,
c AS (SELECT bucket, round(avg(abs_error), 5) AS mae, round(avg(pct_error), 5) AS mape FROM res WHERE bucket IS NOT NULL GROUP BY bucket)
SELECT bucket, mae, previous_mae, round(mae - previous_mae, 5) AS delta_mae, mape, previous_mape, round(mape - previous_mape, 5) AS delta_mape
FROM c JOIN (VALUES ('$0–100', 15.81::DOUBLE, 22.6::DOUBLE), ('$100–200', 25.28, 17.5), ('$200–500', 57.0, 19.6)) p(bucket, previous_mae, previous_mape) USING (bucket)
""")
def bucket_deltas(spark: SparkSession, sf: str) -> DataFrame:
    # Bucket errors of the preceding model.
    previous = spark.createDataFrame(
        [("$0–100", 15.81, 22.6), ("$100–200", 25.28, 17.5), ("$200–500", 57.0, 19.6)], "bucket string, mae double, mape double"
    )
    current = rounded(residuals.bucket_errors(results(spark, sf)), "mae", "mape", digits=5)
    return rounded(residuals.compare_to_previous(current, previous, "bucket", ["mae", "mape"]), "delta_mae", "delta_mape", digits=5)


@query("within_pct", "E6", "WITH " + PREDICTED + """
SELECT round(avg((pct_error <= 10)::INTEGER) * 100, 6) AS within_10, round(avg((pct_error <= 20)::INTEGER) * 100, 6) AS within_20,
       round(avg((pct_error <= 50)::INTEGER) * 100, 6) AS within_50 FROM res
""")
def within_pct(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(residuals.within_shares(results(spark, sf)), "within_10", "within_20", "within_50")


@query("residual_moments", "E7", "WITH " + PREDICTED + """,
m AS (SELECT avg(error) AS mean, stddev_samp(error) AS std, stddev_pop(error) AS sp, quantile_cont(error, 0.5) AS median,
             kurtosis_pop(error) AS kurtosis FROM res),
s AS (SELECT avg(pow(error - mean, 3)) / pow(max(sp), 3) AS skew FROM res, m)
SELECT round(mean, 5) AS mean, round(median, 5) AS median, round(std, 5) AS std, round(skew, 5) AS skew, round(kurtosis, 5) AS kurtosis,
       CASE WHEN mean > 0 THEN 'overpredicts' ELSE 'underpredicts' END AS bias_label,
       CASE WHEN skew > 0.5 THEN 'right' WHEN skew < -0.5 THEN 'left' ELSE 'symmetric' END AS skew_label
FROM m, s
""")
def residual_moments(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(residuals.residual_moments(results(spark, sf)), "mean", "median", "std", "skew", "kurtosis", digits=5)


@query("spearman", "W6", "WITH " + PREDICTED + """,
k AS (SELECT rank() OVER (ORDER BY actual) + (count(*) OVER (PARTITION BY actual) - 1) / 2.0 AS x,
             rank() OVER (ORDER BY abs_error) + (count(*) OVER (PARTITION BY abs_error) - 1) / 2.0 AS y FROM res)
SELECT count(*) AS n, round(corr(x, y), 6) AS r FROM k
""")
def spearman(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(residuals.spearman(results(spark, sf), "actual", "abs_error"), "r")


@query("heteroscedasticity", "E8", "WITH " + PREDICTED + """,
k AS (SELECT rank() OVER (ORDER BY actual) + (count(*) OVER (PARTITION BY actual) - 1) / 2.0 AS x,
             rank() OVER (ORDER BY abs_error) + (count(*) OVER (PARTITION BY abs_error) - 1) / 2.0 AS y FROM res),
s AS (SELECT count(*) AS n, corr(x, y) AS r FROM k)
SELECT n, round(r, 6) AS r, (abs(r) * sqrt((n - 2) / (1 - r * r)) > 1.96)::INTEGER AS significant,
       (r > 0.3 AND abs(r) * sqrt((n - 2) / (1 - r * r)) > 1.96)::INTEGER AS grows FROM s
""")
def heteroscedasticity(spark: SparkSession, sf: str) -> DataFrame:
    """The p-value against the normal limit, which thousands of rows reach."""
    found = residuals.heteroscedasticity(results(spark, sf))
    row = (found["n"], round(found["r"], 6), int(found["p"] < 0.05), int(found["grows"]))
    return spark.createDataFrame([row], "n long, r double, significant int, grows int")


@query("trend_line", "E12", """
WITH t AS (SELECT l_extendedprice AS y, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS a, l_discount AS b FROM lineitem),
f AS (SELECT y, a, b, coalesce(a, (SELECT quantile_cont(a, 0.5) FROM t)) AS fa FROM t)
SELECT 'a' AS feature, round(regr_slope(y, fa), 4) AS slope, round(regr_intercept(y, fa), 3) AS intercept, round(corr(a, y), 6) AS r FROM f
UNION ALL SELECT 'b', round(regr_slope(y, b), 4), round(regr_intercept(y, b), 3), round(corr(b, y), 6) FROM f
""")
def trend_line(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("y"), F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("a"),
        F.col("l_discount").alias("b"),
    )
    lines = residuals.trend_line(rows, ["a", "b"], "y")
    return lines.select("feature", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), F.round("r", 6).alias("r"))


_PROBS = [(i + 0.5) / 99 for i in range(99)]
_THEORY = [NormalDist().inv_cdf(p) for p in _PROBS]


@query("qq_table", "E11", "WITH " + PREDICTED + f""",
q AS (SELECT unnest({_PROBS}) AS prob, unnest({_THEORY}) AS theoretical, unnest(quantile_cont(ln(actual) - ln(predicted), {_PROBS})) AS sample FROM res),
f AS (SELECT regr_slope(sample, theoretical) AS slope, regr_intercept(sample, theoretical) AS intercept, regr_r2(sample, theoretical) AS r2 FROM q)
SELECT round(prob, 9) AS prob, round(theoretical, 9) AS theoretical, round(sample, 6) AS sample, round(slope, 6) AS slope,
       round(intercept, 6) AS intercept, round(r2, 6) AS r2 FROM q, f
""")
def qq_table(spark: SparkSession, sf: str) -> DataFrame:
    logs = results(spark, sf).select((F.ln("actual") - F.ln("predicted")).alias("residual"))
    points = settle(residuals.qq_table(logs, "residual"))
    fit = settle(residuals.qq_fit(points))
    out = points.withColumns({name: fit.select(name).scalar() for name in ("slope", "intercept", "r2")})
    return rounded(rounded(out, "prob", "theoretical", digits=9), "sample", "slope", "intercept", "r2")


@query("lowess_grid", "E10", "WITH " + PREDICTED + """,
e AS (SELECT min(predicted) AS lo, max(predicted) AS hi FROM res),
g AS (SELECT i, lo + (hi - lo) * i / 19 AS x0 FROM e, range(20) r(i)),
d AS (SELECT i, x0, predicted - x0 AS u, error AS y FROM res, g),
h AS (SELECT i, quantile_cont(abs(u), 0.3) AS h FROM d GROUP BY i),
w AS (SELECT i, x0, h, u, y, pow(1 - pow(abs(u) / h, 3), 3) AS w FROM d JOIN h USING (i) WHERE abs(u) < h),
s AS (SELECT i, x0, h, sum(w) AS s, sum(w * u) AS su, sum(w * u * u) AS suu, sum(w * y) AS sy, sum(w * u * y) AS suy FROM w GROUP BY i, x0, h)
SELECT round(x0, 6) AS x0, round(h, 6) AS bandwidth, round((suu * sy - su * suy) / (s * suu - su * su), 4) AS trend FROM s
""")
def lowess_grid(spark: SparkSession, sf: str) -> DataFrame:
    out = residuals.local_trend(results(spark, sf), "predicted", "error")
    return rounded(rounded(out, "x0", "bandwidth"), "trend", digits=4)


@query("largest_errors", "O2", "WITH " + PREDICTED + """
SELECT id, round(actual, 6) AS actual, round(predicted, 6) AS predicted, round(abs_error, 6) AS abs_error, round(pct_error, 6) AS pct_error, o_custkey
FROM res ORDER BY abs_error DESC, id LIMIT 20
""")
def largest_errors(spark: SparkSession, sf: str) -> DataFrame:
    top = residuals.largest_errors(results(spark, sf), "id", 20, ["o_custkey"])
    return rounded(top, "actual", "predicted", "abs_error", "pct_error")


@query("best_and_worst", "O3", "WITH " + PREDICTED + """,
s AS (SELECT * FROM (SELECT 'worst' AS side, * FROM res ORDER BY abs_error DESC, id LIMIT 10)
      UNION ALL SELECT * FROM (SELECT 'best' AS side, * FROM res ORDER BY abs_error, id LIMIT 10))
SELECT side, count(*) AS n, round(min(actual), 6) AS actual_min, round(max(actual), 6) AS actual_max,
       count(CASE WHEN bucket = '$0–100' THEN 1 END) AS bucket_0, count(CASE WHEN bucket = '$100–200' THEN 1 END) AS bucket_1,
       count(CASE WHEN bucket = '$200–500' THEN 1 END) AS bucket_2,
       sum((o_orderpriority = '1-URGENT')::INTEGER)::BIGINT AS sum_urgent, round(avg(o_custkey), 6) AS mean_o_custkey
FROM s GROUP BY side
""")
def best_and_worst(spark: SparkSession, sf: str) -> DataFrame:
    rows = results(spark, sf).withColumn("urgent", (F.col("o_orderpriority") == "1-URGENT").cast("int"))
    sides = residuals.best_and_worst(rows, "id", 10, ["urgent", "o_custkey"])
    out = residuals.error_patterns(sides, ["urgent"], ["o_custkey"])
    return rounded(out, "actual_min", "actual_max", "mean_o_custkey")
