"""Regression metrics and residual analysis over a (actual, predicted) table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthrate.functions.nulls import guarded_corr, ratio
from hearthrate.functions.pricing import (
    BUCKET_EDGES, BUCKET_LABELS, CAPPED_CLIP, TIERS, price_bucket, price_from_log,
)
from hearthrate.operators.cumulative import average_ranks
from hearthrate.operators.profile import _stack
from hearthrate.operators.quantiles import column_medians, group_quantiles, quantile_table


def error_columns(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Signed, absolute and percentage error. Positive means predicted too high."""
    error = F.col(predicted) - F.col(actual)
    return df.withColumns({
        "error": error,
        "abs_error": F.abs(error),
        "pct_error": ratio(F.abs(error) * 100, F.col(actual)),
    })


def results_frame(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    clip: tuple[float, float] | None = CAPPED_CLIP,
    edges: Sequence[float] = BUCKET_EDGES,
    labels: Sequence[str] = BUCKET_LABELS,
    include_right_edge: bool = False,
) -> DataFrame:
    """Dollar-scale results of log-scale predictions with errors and price bucket."""
    dollars = df.withColumns({
        "actual": F.exp(F.col(label)),
        "predicted": price_from_log(F.col(prediction), clip),
    })
    bucket = price_bucket(F.col("actual"), edges, labels, include_right_edge)
    return error_columns(dollars).withColumn("bucket", bucket)


def fit_quality(actual: Column, predicted: Column) -> dict[str, Column]:
    """Aggregates MAE, RMSE and R² of a pair of columns."""
    residual = actual - predicted
    squares = F.sum(residual * residual)
    return {
        "mae": F.avg(F.abs(residual)),
        "rmse": F.sqrt(F.avg(residual * residual)),
        "r2": 1 - F.try_divide(squares, F.var_pop(actual) * F.count(residual)),
    }


def dollar_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    clip: tuple[float, float] | None = CAPPED_CLIP,
    groups: Sequence[str] = (),
) -> DataFrame:
    """n, MAE, RMSE and R² in dollars and R² on the log scale, optionally per group."""
    actual, predicted = F.exp(F.col(label)), price_from_log(F.col(prediction), clip)
    dollars = fit_quality(actual, predicted)
    logs = fit_quality(F.col(label), F.col(prediction))
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        *[column.alias(name) for name, column in dollars.items()],
        logs["r2"].alias("r2_log"),
    )


def bucket_errors(results: DataFrame, bucket: str = "bucket") -> DataFrame:
    """n, MAE, MAPE, median absolute error and bias per bucket; rows without bucket drop out."""
    known = results.where(F.col(bucket).isNotNull())
    sums = known.groupBy(bucket).agg(
        F.count("abs_error").alias("n"),
        F.avg("abs_error").alias("mae"),
        F.avg("pct_error").alias("mape"),
        F.avg("error").alias("bias"),
    )
    medians = group_quantiles(known, "abs_error", [0.5], ["median_error"], [bucket])
    return sums.join(medians, bucket).select(
        bucket, "n", "mae", "mape", "median_error", "bias",
        F.when(F.col("bias") >= 0, "over").otherwise("under").alias("direction"),
    )


def within_shares(results: DataFrame, limits: Sequence[float] = (10, 20, 50)) -> DataFrame:
    """Percentage of rows within each percentage error."""
    return results.agg(*[
        (F.avg((F.col("pct_error") <= limit).cast("double")) * 100).alias(f"within_{int(limit)}") for limit in limits
    ])


def residual_moments(results: DataFrame, error: str = "error") -> DataFrame:
    """Mean, median, std, skewness and excess kurtosis of the error, with labels."""
    e = F.col(error)
    median = quantile_table(results, [error], [0.5]).select(F.col("q")[0])
    return results.agg(
        F.avg(e).alias("mean"),
        F.stddev_samp(e).alias("std"),
        F.skewness(e).alias("skew"),
        F.kurtosis(e).alias("kurtosis"),
    ).select(
        "mean",
        median.scalar().alias("median"),
        "std",
        "skew",
        "kurtosis",
        F.when(F.col("mean") > 0, "overpredicts").otherwise("underpredicts").alias("bias_label"),
        F.when(F.col("skew") > 0.5, "right").when(F.col("skew") < -0.5, "left").otherwise("symmetric").alias("skew_label"),
    )


def t_tail(r: float, n: int) -> float:
    """Two-sided p-value of a correlation under no association (Student t)."""
    if n < 3 or r is None:
        return float("nan")
    if abs(r) >= 1:
        return 0.0
    freedom = n - 2
    return _beta_share(freedom / 2, 0.5, 1 - r * r)


def _beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (Lentz)."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_share(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1 - (a + b) * x / (a + 1), tiny)
    value = d
    for m in range(1, 300):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / (1 + step * d or tiny)
            c = 1 + step / c or tiny
            value *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * value


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """(n, r): rank correlation with average ranks for ties.

    Ranks come from distinct values and are centred before they are multiplied,
    so large tables keep precision.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).alias("x"), F.col(y).alias("y"))
    ranks_x = average_ranks(rows, "x").select("x", F.col("rank").alias("rank_x"))
    ranks_y = average_ranks(rows, "y").select("y", F.col("rank").alias("rank_y"))
    centre = (rows.agg(F.count(F.lit(1))).scalar() + 1) / 2
    centred = rows.join(ranks_x, "x").join(ranks_y, "y").select(
        (F.col("rank_x") - centre).alias("a"), (F.col("rank_y") - centre).alias("b")
    )
    sums = centred.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("a") * F.col("b")).alias("ab"),
        F.sum(F.col("a") * F.col("a")).alias("aa"),
        F.sum(F.col("b") * F.col("b")).alias("bb"),
    )
    return sums.select("n", ratio(F.col("ab"), F.sqrt(F.col("aa")) * F.sqrt(F.col("bb"))).alias("r"))


def heteroscedasticity(results: DataFrame) -> dict:
    """Spearman of actual price and error size with p-value; grows if r > 0.3 and p < 0.05."""
    row = spearman(results, "actual", "abs_error").first()
    p = t_tail(row["r"], row["n"])
    return {"n": row["n"], "r": row["r"], "p": p, "grows": bool(row["r"] is not None and row["r"] > 0.3 and p < 0.05)}


def trend_line(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, slope, intercept, r) of the straight line per feature; gaps take the median."""
    medians = column_medians(df, list(features))
    aggregates, cells = [], []
    y = F.col(target).cast("double")
    for i, name in enumerate(features):
        raw = F.col(name).cast("double")
        x = F.coalesce(raw, F.lit(medians.get(name)).cast("double"))
        aggregates += [
            F.regr_slope(y, x).alias(f"slope{i}"),
            F.regr_intercept(y, x).alias(f"intercept{i}"),
            guarded_corr(raw, y).alias(f"r{i}"),
        ]
        cells.append([
            F.lit(name).alias("feature"), F.col(f"slope{i}").alias("slope"),
            F.col(f"intercept{i}").alias("intercept"), F.col(f"r{i}").alias("r"),
        ])
    return _stack(df.agg(*aggregates), cells)


def qq_table(df: DataFrame, residual: str, points: int = 99) -> DataFrame:
    """(prob, theoretical, sample): normal against sample quantiles at evenly spaced probabilities."""
    probs = [(i + 0.5) / points for i in range(points)]
    normal = NormalDist()
    rows = [(i, p, normal.inv_cdf(p)) for i, p in enumerate(probs)]
    theory = df.sparkSession.createDataFrame(rows, "at int, prob double, theoretical double")
    sample = quantile_table(df, [residual], probs).select(F.posexplode("q").alias("at", "sample"))
    return theory.join(sample, "at").select("prob", "theoretical", "sample")


def qq_fit(points: DataFrame) -> DataFrame:
    """Slope, intercept and R² of the quantile-quantile line."""
    y, x = F.col("sample"), F.col("theoretical")
    return points.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )


def local_trend(df: DataFrame, x: str, y: str, fraction: float = 0.3, points: int = 20) -> DataFrame:
    """(x0, bandwidth, trend): local straight-line fit at a grid of points over the range of ``x``.

    Tricube weights; the bandwidth at a point is the distance that holds the
    given fraction of the rows. One aggregate per pass, no row leaves its task.
    """
    slim = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    edges = slim.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if edges["lo"] is None:
        return slim.sparkSession.createDataFrame([], "x0 double, bandwidth double, trend double")
    grid = [edges["lo"] + (edges["hi"] - edges["lo"]) * i / (points - 1) for i in range(points)]
    distances = slim.select(*[F.abs(F.col("x") - F.lit(g)).alias(f"d{i}") for i, g in enumerate(grid)])
    reach = {row["column"]: row["q"][0] for row in quantile_table(distances, distances.columns, [fraction]).collect()}

    aggregates, cells = [], []
    for i, g in enumerate(grid):
        width = max(reach[f"d{i}"], 1e-12)
        u = f"(x - double('{g!r}'))"
        scaled = f"(abs({u}) / double('{width!r}'))"
        core = f"(1 - {scaled} * {scaled} * {scaled})"
        w = f"(CASE WHEN {scaled} < 1 THEN {core} * {core} * {core} END)"
        aggregates += [
            F.expr(f"sum({w}{factor}) AS {stem}{i}")
            for stem, factor in (("s", ""), ("su", f" * {u}"), ("suu", f" * {u} * {u}"), ("sy", " * y"), ("suy", f" * {u} * y"))
        ]
        determinant = f"(s{i} * suu{i} - su{i} * su{i})"
        cells.append([
            F.lit(g).alias("x0"), F.lit(width).alias("bandwidth"),
            F.expr(f"""coalesce(
                CASE WHEN abs({determinant}) > 1e-9 * s{i} * suu{i}
                     THEN try_divide(suu{i} * sy{i} - su{i} * suy{i}, {determinant}) END,
                try_divide(sy{i}, s{i})) AS trend"""),
        ])
    chunk = 10
    parts = []
    for start in range(0, points, chunk):
        sums = slim.agg(*aggregates[start * 5 : (start + chunk) * 5])
        parts.append(_stack(sums, cells[start : start + chunk]))
    return reduce(DataFrame.unionByName, parts)


def largest_errors(results: DataFrame, key: str, rows: int = 20, attributes: Sequence[str] = ()) -> DataFrame:
    """The rows with the largest absolute error and their attributes."""
    return results.orderBy(F.desc("abs_error"), key).limit(rows).select(
        key, "actual", "predicted", "abs_error", "pct_error", *attributes
    )


def best_and_worst(results: DataFrame, key: str, rows: int = 10, attributes: Sequence[str] = ()) -> DataFrame:
    """(side, ...) of the rows with the largest and smallest errors."""
    columns = [key, "actual", "predicted", "abs_error", "pct_error", "bucket", *attributes]
    worst = results.orderBy(F.desc("abs_error"), key).limit(rows).select(F.lit("worst").alias("side"), *columns)
    best = results.orderBy(F.asc("abs_error"), key).limit(rows).select(F.lit("best").alias("side"), *columns)
    return worst.unionByName(best)


def error_patterns(
    sides: DataFrame, flags: Sequence[str] = (), means: Sequence[str] = (), labels: Sequence[str] = BUCKET_LABELS
) -> DataFrame:
    """Price range, bucket counts, flag sums and attribute means of the best and the worst rows."""
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("actual").alias("actual_min"),
        F.max("actual").alias("actual_max"),
        *[F.count(F.when(F.col("bucket") == label, 1)).alias(f"bucket_{i}") for i, label in enumerate(labels)],
        *[F.sum(F.col(c).cast("long")).alias(f"sum_{c}") for c in flags],
        *[F.avg(c).alias(f"mean_{c}") for c in means],
    )


def tier_errors(results: DataFrame, tier: str = "tier") -> DataFrame:
    """n, MAE, RMSE, MAPE, shares within 10 and 20 percent, and bias per tier."""
    return results.groupBy(tier).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("abs_error") * F.col("abs_error"))).alias("rmse"),
        F.avg("pct_error").alias("mape"),
        (F.avg((F.col("pct_error") <= 10).cast("double")) * 100).alias("within_10"),
        (F.avg((F.col("pct_error") <= 20).cast("double")) * 100).alias("within_20"),
        F.avg("error").alias("bias"),
    )


def tier_distribution(results: DataFrame, tier: str = "tier") -> DataFrame:
    """(tier, position, n, pct) for every tier in fixed order, zero where empty."""
    total = F.count(F.lit(1))
    counts = results.agg(
        total.alias("total"), *[F.count(F.when(F.col(tier) == name, 1)).alias(name) for name in TIERS]
    )
    return _stack(counts, [
        [
            F.lit(name).alias("tier"), F.lit(i).alias("position"), F.col(name).alias("n"),
            (ratio(F.col(name), F.col("total")) * 100).alias("pct"),
        ]
        for i, name in enumerate(TIERS)
    ])


def tier_ordering(results: DataFrame, tier: str = "tier") -> DataFrame:
    """MAE per tier side by side, whether it rises from HIGH to LOW, and the lift."""
    maes = results.agg(*[F.avg(F.when(F.col(tier) == t, F.col("abs_error"))).alias(f"mae_{t.lower()}") for t in TIERS])
    high, medium, low = (F.col(f"mae_{t.lower()}") for t in TIERS)
    return maes.select(
        high, medium, low,
        F.coalesce(((high < medium) & (medium < low)).cast("int"), F.lit(0)).alias("ordered"),
        (low - high).alias("lift"),
        ((ratio(low, high) - 1) * 100).alias("lift_pct"),
    )


def in_range(df: DataFrame) -> DataFrame:
    covered = (F.col("actual") >= F.col("range_low")) & (F.col("actual") <= F.col("range_high"))
    return df.withColumn("in_range", F.coalesce(covered.cast("int"), F.lit(0)))


def range_coverage(results: DataFrame, tier: str = "tier") -> DataFrame:
    """Rows inside their price range and mean range width, per tier and overall ("ALL").

    Each row counts towards its tier and the total in one aggregate.
    """
    measured = in_range(results).select(
        F.explode(F.array(F.col(tier), F.lit("ALL"))).alias("tier"),
        "in_range",
        (F.col("range_high") - F.col("range_low")).alias("width"),
    )
    return measured.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("in_range").alias("covered"),
        (F.avg("in_range") * 100).alias("coverage_pct"),
        F.avg("width").alias("mean_width"),
    )


def tier_examples(results: DataFrame, key: str, tier: str = "tier") -> DataFrame:
    """One row per tier, preferably one whose price lies in its range, then the smallest key."""
    best = Window.partitionBy(tier).orderBy(F.desc("in_range"), F.asc(key))
    return in_range(results).withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= 1).drop("_rank")


def compare_to_previous(current: DataFrame, previous: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Each metric beside its earlier value, and the change. Both tables hold one row per key."""
    before = previous.select(key, *[F.col(m).alias(f"previous_{m}") for m in metrics])
    return current.join(before, key, "left").select(
        key,
        *[c for m in metrics for c in (
            F.col(m), F.col(f"previous_{m}"), (F.col(m) - F.col(f"previous_{m}")).alias(f"delta_{m}"),
        )],
    )
