"""Models on line items: the price is explained by quantity, discount, tax and line number."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.functions.keyed import fold_of, split_side
from hearthrate.functions.pricing import WIDE_CLIP
from hearthrate.operators import models
from hearthrate.operators.design import assemble_vector, contiguous_folds, standardise
from hearthrate.operators.residuals import dollar_metrics
from hearthrate.operators.tree_bins import predict_by_bins
from hearthrate.session import allow_checkpoints, scratch_path, settle, spread
from suite.registry import query, rounded, table

FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
KEY_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
LINES_SQL = f"""
t AS (SELECT {KEY_SQL} AS id, l_quantity AS x, ln(l_extendedprice / 250.0 + 3 * l_quantity) AS y FROM lineitem),
h AS (SELECT *, substr(md5('42|' || id), 1, 8) AS h42, substr(md5('7|' || id), 1, 8) AS h7 FROM t)
"""


def line_table(spark: SparkSession, sf: str) -> DataFrame:
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    price = F.col("l_extendedprice") / 250.0 + 3 * F.col("l_quantity")
    # The trees make many passes and the keys are hashed, so few input splits would idle most cores.
    source = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", *FEATURES)
    lines = spread(source).select(
        key.alias("id"), F.ln(price).alias("label"), *[F.col(c).cast("double").alias(c) for c in FEATURES]
    )
    return lines.withColumns({"side": split_side(F.col("id")), "fold": fold_of(F.col("id"), 5, seed=7)})


def vectors(spark: SparkSession, sf: str, features: list[str]) -> DataFrame:
    return assemble_vector(line_table(spark, sf), features)


def sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.where(F.col("side") == "train"), rows.where(F.col("side") == "test")


_METRICS_SQL = """
SELECT count(*) AS n, round(avg(abs(exp(y) - p)), 5) AS mae, round(sqrt(avg((exp(y) - p) * (exp(y) - p))), 5) AS rmse,
       round(1 - sum((exp(y) - p) * (exp(y) - p)) / (var_pop(exp(y)) * count(*)), 6) AS r2,
       round(1 - sum((y - l) * (y - l)) / (var_pop(y) * count(*)), 6) AS r2_log
"""


@query("linear_fit_metrics", "R1 M10 E1 E2", "WITH " + LINES_SQL + """,
f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM h WHERE h42 >= '33333333'),
p AS (SELECT y, a + b * x AS l, exp(least(greatest(a + b * x, ln(1.0)), ln(200000.0))) AS p FROM h, f WHERE h42 < '33333333')
""" + _METRICS_SQL + " FROM p")
def linear_fit_metrics(spark: SparkSession, sf: str) -> DataFrame:
    train, test = sides(vectors(spark, sf, ["l_quantity"]))
    scored = models.linear().fit(train).transform(test)
    out = dollar_metrics(scored, clip=WIDE_CLIP)
    return out.select("n", F.round("mae", 5).alias("mae"), F.round("rmse", 5).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("r2_log", 6).alias("r2_log"))


def ridge_maker(train: DataFrame, standardised: bool = True):
    row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("s")).first()
    return models.ridge(row["n"], row["s"], standardised=standardised)


@query("ridge", "R2 M9", "WITH " + LINES_SQL + """,
z AS (SELECT id, y, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS z FROM h),
f AS (SELECT avg(y) AS ybar, (sum(z * y) - avg(y) * sum(z)) / (count(*) + 10.0) AS w FROM z),
p AS (SELECT y, ybar + w * z AS l, exp(least(greatest(ybar + w * z, ln(1.0)), ln(200000.0))) AS p FROM z, f)
""" + _METRICS_SQL + ", round(max(w), 9) AS weight FROM p, f")
def ridge(spark: SparkSession, sf: str) -> DataFrame:
    rows = assemble_vector(standardise(line_table(spark, sf), ["l_quantity"]), ["l_quantity"])
    fitted = ridge_maker(rows).fit(rows)
    out = dollar_metrics(fitted.transform(rows), clip=WIDE_CLIP)
    return out.select(
        "n", F.round("mae", 5).alias("mae"), F.round("rmse", 5).alias("rmse"), F.round("r2", 6).alias("r2"),
        F.round("r2_log", 6).alias("r2_log"), F.round(F.lit(float(fitted.coefficients[0])), 9).alias("weight"),
    )


_FOLD = "CASE WHEN h7 < '33333334' THEN 0 WHEN h7 < '66666667' THEN 1 WHEN h7 < '9999999a' THEN 2 WHEN h7 < 'cccccccd' THEN 3 ELSE 4 END"
_FOLDS_SQL = "WITH " + LINES_SQL + f""",
g AS (SELECT *, {_FOLD} AS fold FROM h),
f AS (SELECT k AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM g, range(5) r(k) WHERE fold <> k GROUP BY k),
p AS (SELECT fold, y, a + b * x AS l, exp(least(greatest(a + b * x, ln(1.0)), ln(1000.0))) AS p FROM g JOIN f USING (fold)),
cv AS ({_METRICS_SQL.replace('SELECT count(*) AS n', 'SELECT fold::INTEGER AS fold, count(*) AS n')} FROM p GROUP BY fold)
"""


def linear_folds(spark: SparkSession, sf: str) -> DataFrame:
    return models.cross_validate(vectors(spark, sf, ["l_quantity"]), "fold", 5, lambda _: models.linear())


@query("cv_table", "R5 R6 M11", _FOLDS_SQL + "SELECT *, (SELECT sum(n) FROM cv)::BIGINT - n AS n_train FROM cv")
def cv_table(spark: SparkSession, sf: str) -> DataFrame:
    out = linear_folds(spark, sf)
    return out.select(
        "fold", "n", F.round("mae", 5).alias("mae"), F.round("rmse", 5).alias("rmse"), F.round("r2", 6).alias("r2"),
        F.round("r2_log", 6).alias("r2_log"), "n_train",
    )


@query("cv_summary", "R6 V5", _FOLDS_SQL + """
SELECT count(*) AS folds, round(avg(mae), 4) AS mae_mean, round(stddev_pop(mae), 4) AS mae_std, round(min(mae), 4) AS mae_min,
       round(max(mae), 4) AS mae_max, round(max(mae) - min(mae), 4) AS mae_spread, arg_min(fold, mae) AS best_fold,
       arg_max(fold, mae) AS worst_fold, (stddev_pop(mae) < 3)::INTEGER AS stable
FROM cv
""")
def cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = models.cross_validation_summary(rounded(linear_folds(spark, sf), "mae", digits=5))
    return rounded(out, "mae_mean", "mae_std", "mae_min", "mae_max", "mae_spread", digits=4).select(
        "folds", "mae_mean", "mae_std", "mae_min", "mae_max", "mae_spread", "best_fold", "worst_fold", "stable"
    )


@query("contiguous_cv", "M11 R5", """
WITH t AS (SELECT o_orderkey AS id, o_custkey::DOUBLE AS x, ln(o_totalprice / 900.0) AS y, ntile(5) OVER (ORDER BY o_orderkey) - 1 AS fold FROM orders),
f AS (SELECT k AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t, range(5) r(k) WHERE fold <> k GROUP BY k),
p AS (SELECT fold, y, exp(least(greatest(a + b * x, ln(1.0)), ln(1000.0))) AS p FROM t JOIN f USING (fold))
SELECT fold::INTEGER AS fold, count(*) AS n, round(avg(abs(exp(y) - p)), 5) AS mae FROM p GROUP BY fold
""")
def contiguous_cv(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("double").alias("x"), F.ln(F.col("o_totalprice") / 900.0).alias("label")
    )
    folded = contiguous_folds(assemble_vector(rows, ["x"]), "id", 5)
    out = models.cross_validate(folded, "fold", 5, lambda _: models.linear())
    return out.select("fold", "n", F.round("mae", 5).alias("mae"))


@query("learning_curve", "R10 O7", "WITH " + LINES_SQL + """,
tr AS (SELECT x, y, row_number() OVER (ORDER BY substr(md5('42|' || id), 1, 13), id) AS k, count(*) OVER () AS total FROM h WHERE h42 >= '33333333'),
s AS (SELECT frac, x, y FROM tr, (VALUES (0.2::DOUBLE), (0.4), (0.6), (0.8), (1.0)) v(frac) WHERE k <= floor(total * frac)),
f AS (SELECT frac, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM s GROUP BY frac),
seen AS (SELECT frac, count(*) AS n, avg(abs(exp(y) - exp(a + b * x))) AS mae FROM s JOIN f USING (frac) GROUP BY frac),
un AS (SELECT frac, avg(abs(exp(y) - exp(a + b * x))) AS mae FROM h, f WHERE h42 < '33333333' GROUP BY frac)
SELECT frac AS fraction, n AS n_train, round(seen.mae, 5) AS train_mae, round(un.mae, 5) AS val_mae, round(un.mae - seen.mae, 5) AS gap
FROM seen JOIN un USING (frac)
""")
def learning_curve(spark: SparkSession, sf: str) -> DataFrame:
    train, test = sides(vectors(spark, sf, ["l_quantity"]))
    return rounded(
        models.learning_curve(train, test, "id", lambda _: models.linear()), "train_mae", "val_mae", "gap", digits=5
    )


@query("training_prefix", "O7", """
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY substr(md5('42|' || o_orderkey::VARCHAR), 1, 13), o_orderkey) AS k,
  count(*) OVER () AS total FROM orders) WHERE k <= floor(total * 0.6::DOUBLE)
""")
def training_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return models.training_prefix(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.6)


# What SQL can state of a tree model: all test rows are scored, within the range of the labels, from a bounded fit.
_SCORED_SQL = "WITH " + LINES_SQL + "SELECT count(*) AS n, count(*) AS in_range, 1 AS bounded FROM h WHERE h42 < '33333333'"


def scored_rows(model, train: DataFrame, test: DataFrame, most: int) -> DataFrame:
    drawn = models.draw_rows(train, "id", most).count()
    # Boosting may add small steps beyond the range, so a tenth of it is allowed.
    low, high = train.agg(F.min("label"), F.max("label")).first()
    slack = 0.1 * (high - low)
    inside = F.sum(F.col("prediction").between(low - slack, high + slack).cast("long"))
    return predict_by_bins(model, test).agg(F.count(F.lit(1)).alias("n"), inside.alias("in_range")).withColumn("bounded", F.lit(int(drawn <= 1.1 * most)))


@query("forest", "R3", _SCORED_SQL)
def forest(spark: SparkSession, sf: str) -> DataFrame:
    train, test = sides(vectors(spark, sf, FEATURES))
    return scored_rows(models.fit_on_draw(models.forest(), train, "id", models.FOREST_ROWS), train, test, models.FOREST_ROWS)


@query("boosted", "R4", _SCORED_SQL)
def boosted(spark: SparkSession, sf: str) -> DataFrame:
    allow_checkpoints(spark)
    train, test = sides(vectors(spark, sf, FEATURES))
    return scored_rows(models.fit_on_draw(models.boosted(), train, "id"), train, test, models.FIT_ROWS)


@query("model_comparison", "R7 R1 R2 R3 R4")
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    allow_checkpoints(spark)
    rows = vectors(spark, sf, FEATURES).persist()
    train, test = sides(rows)
    trained = [
        models.train_and_evaluate("linear", lambda _: models.linear(), train, test, clip=WIDE_CLIP),
        models.train_and_evaluate("ridge", lambda t: ridge_maker(t, standardised=False), train, test, clip=WIDE_CLIP),
        models.train_and_evaluate("forest", lambda _: models.forest(), train, test, clip=WIDE_CLIP),
        models.train_and_evaluate("boosted", lambda _: models.boosted(), train, test, clip=WIDE_CLIP),
    ]
    rows.unpersist()
    return models.comparison_table(train, trained).drop("train_time")


_ALPHAS = ", ".join(f"({i + 1}, {a!r}::DOUBLE)" for i, a in enumerate(models.penalties()))


@query("search", "R8 R9", "WITH " + LINES_SQL + f""",
g AS (SELECT *, {_FOLD} AS fold FROM h WHERE h42 >= '33333333'),
alpha(trial, alpha) AS (VALUES {_ALPHAS}),
f AS (SELECT k AS fold, count(*) AS n, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, covar_pop(x, y) AS c FROM g, range(5) r(k) WHERE fold <> k GROUP BY k),
p AS (SELECT trial, fold, avg(abs(exp(y) - exp(least(greatest(my + n * c / sx / (n + alpha) * (x - mx) / sx, ln(1.0)), ln(1000.0))))) AS mae
  FROM g JOIN f USING (fold), alpha GROUP BY ALL),
tr AS (SELECT trial, alpha, avg(mae) AS mae FROM p JOIN alpha USING (trial) GROUP BY ALL),
b AS (SELECT *, min(mae) OVER (ORDER BY trial) AS best_so_far, min(mae) OVER (ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM tr),
w AS (SELECT count(*) AS n, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, covar_pop(x, y) AS c, (SELECT arg_min(alpha, mae) FROM tr) AS a FROM g),
e AS (SELECT avg(abs(exp(y) - exp(least(greatest(my + n * c / sx / (n + a) * (x - mx) / sx, ln(1.0)), ln(1000.0))))) AS test_mae FROM h, w WHERE h42 < '33333333')
SELECT trial, round(alpha, 6) AS alpha, round(mae, 6) AS mae, round(best_so_far, 6) AS best_so_far, (before IS NULL OR mae < before)::INTEGER AS improved, round(test_mae, 5) AS test_mae
FROM b, e
""")
def search(spark: SparkSession, sf: str) -> DataFrame:
    """The log of 30 penalties over 5 folds, with the test error of the best one refitted, saved and read back."""
    rows = vectors(spark, sf, ["l_quantity"]).persist()
    train, test = sides(rows)
    trials = models.ridge_search(train, ["l_quantity"], "fold", models.penalties())
    row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("s")).first()
    alpha = trials.orderBy("mae", "trial").first()["alpha"]
    path = scratch_path(spark, "best")
    models.ridge(row["n"], row["s"], alpha).fit(train).write().save(path)
    best = LinearRegressionModel.load(path)
    out = trials.withColumn("test_mae", F.round(dollar_metrics(best.transform(test)).select("mae").scalar(), 5))
    return settle(rounded(out, "alpha", "mae", "best_so_far"), rows)


@query("best_so_far", "R8", """
WITH t AS (SELECT (o_custkey % 500)::INTEGER AS trial, round(avg(o_totalprice), 4) AS mae FROM orders GROUP BY 1),
b AS (SELECT *, min(mae) OVER (ORDER BY trial) AS best_so_far, min(mae) OVER (ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM t)
SELECT trial, mae, best_so_far, (p IS NULL OR mae < p)::INTEGER AS improved FROM b
""")
def best_so_far(spark: SparkSession, sf: str) -> DataFrame:
    trials = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 500).cast("int").alias("trial")).agg(
        F.round(F.avg("o_totalprice"), 4).alias("mae")
    )
    return models.best_so_far(trials)


@query("curve_verdict", "R10", """
WITH c AS (SELECT (l_linenumber / 7.0)::DOUBLE AS fraction, avg(l_extendedprice) AS val_mae, avg(l_extendedprice) - avg(l_quantity) AS gap FROM lineitem GROUP BY 1),
v AS (SELECT arg_max(gap, fraction) AS final_gap, arg_min(val_mae, fraction) - arg_max(val_mae, fraction) AS gain FROM c)
SELECT round(final_gap, 5) AS final_gap, round(gain, 5) AS gain, CASE WHEN final_gap > 5 THEN 'overfit' ELSE 'healthy' END AS fit_label,
       CASE WHEN gain > 3 THEN 'more data helps' ELSE 'plateau' END AS data_label
FROM v
""")
def curve_verdict(spark: SparkSession, sf: str) -> DataFrame:
    curve = table(spark, sf, "lineitem").groupBy((F.col("l_linenumber") / 7.0).alias("fraction")).agg(
        F.avg("l_extendedprice").alias("val_mae"), (F.avg("l_extendedprice") - F.avg("l_quantity")).alias("gap")
    )
    return rounded(models.curve_verdict(curve), "final_gap", "gain", digits=5)
