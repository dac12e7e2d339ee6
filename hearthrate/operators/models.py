"""Price regressors on MLlib: estimators, cross-validation, search, curves and comparison."""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, Window, functions as F

from hearthrate.functions.keyed import key_number
from hearthrate.functions.nulls import ratio
from hearthrate.functions.pricing import CAPPED_CLIP, price_from_log
from hearthrate.operators.quantiles import column_quantiles
from hearthrate.operators.residuals import dollar_metrics
from hearthrate.operators.tree_bins import predict_by_bins
from hearthrate.session import allow_checkpoints, settle

# Model settings and search ranges.
RIDGE_ALPHA = 10.0
FOREST = {"numTrees": 300, "minInstancesPerNode": 5, "maxDepth": 30}
# Memory for the statistics of the nodes that one round of a forest splits.
FOREST_MEMORY_MB = 1024
BOOSTED = {"maxIter": 500, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "validationTol": 1e-4}
SEED = 42
TRIALS = 30
SEARCH_RANGES = {
    "n_estimators": ("int", 100, 1000),
    "max_depth": ("int", 3, 10),
    "learning_rate": ("log", 0.01, 0.3),
    "subsample": ("float", 0.6, 1.0),
    "colsample_bytree": ("float", 0.6, 1.0),
    "min_child_weight": ("int", 1, 10),
    "reg_alpha": ("float", 0.0, 10.0),
    "reg_lambda": ("float", 0.0, 10.0),
}
# Rows a tree model is fitted on, about, where a draw is asked for; all rows are scored. Its many rounds pass over these
# rows again and again, so they are drawn by key once, kept in few partitions, and the fit costs the same at any table size.
FIT_ROWS = 20_000
# A deep forest holds a node for every few rows in each tree, on the driver, so it is given fewer.
FOREST_ROWS = 2_000
# Share of the drawn rows that tell when further rounds of boosting stop to help.
VALIDATION_SHARE = 0.2
FIT_PARTITION_ROWS = 5_000
# Rows of a task when boosting runs over a whole table: with fewer the start of the tasks takes longer than their work.
WHOLE_PARTITION_ROWS = 50_000
# Another seed than that of splits and folds, whose sides a draw of low hashes would otherwise follow.
DRAW_SEED = 1009
CURVE_FRACTIONS = (0.2, 0.4, 0.6, 0.8, 1.0)
STABLE_FOLD_STD = 3.0
OVERFIT_GAP = 5.0
STILL_IMPROVING = 3.0


def linear() -> LinearRegression:
    return LinearRegression(regParam=0.0, solver="auto")


def ridge(rows: int, label_std: float, alpha: float = RIDGE_ALPHA, standardised: bool = False) -> LinearRegression:
    """Ridge on standardised features with the penalty ``alpha * |w|²`` next to the residual sum.

    MLlib minimises ``RSS / 2n + (regParam / label_std) / 2 * |w|²``, hence the
    scaling. Raw features are standardised inside MLlib; ``standardised`` says
    that the input already is.
    """
    return LinearRegression(
        regParam=alpha / rows * label_std, elasticNetParam=0.0, standardization=not standardised, solver="normal"
    )


def forest(**overrides) -> RandomForestRegressor:
    return RandomForestRegressor(seed=SEED, maxMemoryInMB=FOREST_MEMORY_MB, **{**FOREST, **overrides})


def boosted(**overrides) -> GBTRegressor:
    """Gradient-boosted trees. MLlib has no L1/L2 penalty and samples columns per node."""
    return GBTRegressor(seed=SEED, **{**BOOSTED, **overrides})


def draw_rows(df: DataFrame, key: str, most: int = FIT_ROWS, seed: int = DRAW_SEED, part_rows: int = FIT_PARTITION_ROWS) -> DataFrame:
    """About ``most`` rows for a tree fit: those whose key hashes below a bound that one count gives.

    With a share p of the rows wanted each key is in or out by its own hash, so the draw needs no sort, holds
    under retries, and misses ``most`` by a few times its square root. Tables of at most ``most`` rows are taken whole.
    """
    rows = df.count()
    parts = max(1, -(-min(rows, most) // part_rows))
    if rows > most:
        df = df.where(key_number(F.col(key), seed) < int((1 << 52) * most / rows))
    return df.repartition(parts, key)


def fit_on_draw(estimator: Estimator, df: DataFrame, key: str, most: int = FIT_ROWS) -> Model:
    """Fit on the drawn rows, kept in memory for the rounds.

    Boosting sets some of them aside: its rounds end, at the latest after ``maxIter``, when one lowers their
    squared error by less than ``validationTol`` of it.
    """
    # A forest looks every row up in all its trees, so its rows are dealt more thinly.
    deep = isinstance(estimator, RandomForestRegressor)
    drawn = draw_rows(df, key, most, part_rows=FOREST_ROWS // 8 if deep else FIT_PARTITION_ROWS)
    if isinstance(estimator, GBTRegressor):
        drawn = drawn.withColumn("validation", key_number(F.col(key), DRAW_SEED + 1) < int((1 << 52) * VALIDATION_SHARE))
        estimator = estimator.copy().setValidationIndicatorCol("validation")
    drawn = drawn.persist(StorageLevel.MEMORY_AND_DISK)
    model = estimator.fit(drawn)
    drawn.unpersist()
    return model


def fit_on_all(estimator: Estimator, df: DataFrame) -> Model:
    """Fit on every row: a forest grows all its trees and boosting runs all its rounds, with no rows set aside."""
    if isinstance(estimator, RandomForestRegressor):
        # The rows remember their nodes, or else each task is sent the trees, which hold a node for every few rows.
        allow_checkpoints(df.sparkSession)
        estimator = estimator.copy().setCacheNodeIds(True)
    elif isinstance(estimator, GBTRegressor):
        allow_checkpoints(df.sparkSession)
        df = df.coalesce(max(1, df.count() // WHOLE_PARTITION_ROWS))
    return estimator.fit(df)


def boosted_from(params: Mapping[str, float]) -> GBTRegressor:
    """Boosted trees for a point of the search space. Penalties have no MLlib counterpart and are only recorded."""
    return boosted(
        maxIter=int(params["n_estimators"]),
        maxDepth=int(params["max_depth"]),
        stepSize=float(params["learning_rate"]),
        subsamplingRate=float(params["subsample"]),
        featureSubsetStrategy=str(round(float(params["colsample_bytree"]), 6)),
        minInstancesPerNode=int(params["min_child_weight"]),
    )


def cross_validate(
    df: DataFrame,
    fold: str,
    folds: int,
    make: Callable[[DataFrame], Estimator],
    clip: tuple[float, float] | None = CAPPED_CLIP,
) -> DataFrame:
    """(fold, n_train, n, mae, rmse, r2, r2_log): each fold predicted by a model of the others."""
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    scored = []
    for i in range(folds):
        train = data.where(F.col(fold) != i)
        model = make(train).fit(train)
        scored.append(model.transform(data.where(F.col(fold) == i)).select(fold, "label", "prediction"))
    metrics = dollar_metrics(reduce(DataFrame.unionByName, scored), clip=clip, groups=[fold])
    whole = data.agg(F.count(F.lit(1)))
    return settle(metrics.withColumn("n_train", whole.scalar() - F.col("n")), data)


def cross_validation_summary(folds: DataFrame, fold: str = "fold") -> DataFrame:
    """Mean, population std, min, max, spread and variation of the fold MAE; best and worst fold."""
    mean, std = F.avg("mae"), F.stddev_pop("mae")
    return folds.agg(
        F.count(F.lit(1)).alias("folds"),
        mean.alias("mae_mean"),
        std.alias("mae_std"),
        F.min("mae").alias("mae_min"),
        F.max("mae").alias("mae_max"),
        (F.max("mae") - F.min("mae")).alias("mae_spread"),
        (ratio(std, mean) * 100).alias("variation_pct"),
        F.avg("rmse").alias("rmse_mean"),
        F.stddev_pop("rmse").alias("rmse_std"),
        F.avg("r2").alias("r2_mean"),
        F.min_by(fold, F.struct("mae", fold)).alias("best_fold"),
        F.max_by(fold, F.struct(F.col("mae"), -F.col(fold))).alias("worst_fold"),
    ).withColumn(
        "label",
        F.when(F.col("variation_pct") < 5, "low").when(F.col("variation_pct") < 10, "moderate").otherwise("high"),
    ).withColumn("stable", (F.col("mae_std") < STABLE_FOLD_STD).cast("int"))


@dataclass
class Trained:
    """A fitted model with its metrics."""

    name: str
    model: Model
    metrics: dict[str, float]


def train_and_evaluate(
    name: str,
    make: Callable[[DataFrame], Estimator],
    train: DataFrame,
    test: DataFrame,
    fold: str | None = None,
    folds: int = 5,
    clip: tuple[float, float] | None = CAPPED_CLIP,
    draw: tuple[str, int] | None = None,
) -> Trained:
    """Cross-validate on the training side if asked, refit on all of it, measure on both sides.

    Only a caller that gives ``draw`` (key, rows) has the rows of the refit bounded; all rows of both sides are measured.
    """
    started = time.monotonic()
    metrics: dict[str, float] = {}
    if fold is not None:
        cv = cross_validation_summary(cross_validate(train, fold, folds, make, clip), fold).first()
        metrics.update(cv_mae_mean=cv["mae_mean"], cv_mae_std=cv["mae_std"], cv_rmse_mean=cv["rmse_mean"],
                       cv_rmse_std=cv["rmse_std"], cv_r2_mean=cv["r2_mean"])
    model = fit_on_draw(make(train), train, *draw) if draw else fit_on_all(make(train), train)
    metrics["train_time"] = time.monotonic() - started
    sides = {"train": train, "test": test}
    if isinstance(model, (RandomForestRegressionModel, GBTRegressionModel)):
        # The thresholds of the trees are read once for both sides.
        parts = [data.select("label", model.getFeaturesCol(), F.lit(side).alias("side")) for side, data in sides.items()]
        scored = predict_by_bins(model, reduce(DataFrame.unionByName, parts))
        found = {row["side"]: row.asDict() for row in dollar_metrics(scored, clip=clip, groups=["side"]).collect()}
    else:
        found = {side: dollar_metrics(model.transform(data), clip=clip).first().asDict() for side, data in sides.items()}
    for side in sides:
        metrics.update({f"{side}_{m}": found.get(side, {}).get(m) for m in ("mae", "rmse", "r2")})
    return Trained(name, model, metrics)


def comparison_table(df: DataFrame, trained: Sequence[Trained]) -> DataFrame:
    """One row per model ordered by test MAE; the first is the best."""
    names = sorted({m for t in trained for m in t.metrics})
    rows = [(t.name, *[t.metrics.get(m) for m in names]) for t in trained]
    schema = "model string, " + ", ".join(f"{m} double" for m in names)
    table = df.sparkSession.createDataFrame(rows, schema)
    return table.withColumn(
        "best", (F.col("test_mae") == table.agg(F.min("test_mae")).scalar()).cast("int")
    ).orderBy("test_mae")


def draw_parameters(trials: int, seed: int = SEED, ranges: Mapping = SEARCH_RANGES) -> list[dict[str, float]]:
    """Reproducible random points of the search space."""
    source = random.Random(seed)
    points = []
    for _ in range(trials):
        point = {}
        for name, (kind, low, high) in ranges.items():
            if kind == "int":
                point[name] = source.randint(low, high)
            elif kind == "log":
                point[name] = math.exp(source.uniform(math.log(low), math.log(high)))
            else:
                point[name] = source.uniform(low, high)
        points.append(point)
    return points


def random_search(
    df: DataFrame,
    fold: str,
    folds: int,
    points: Sequence[Mapping[str, float]],
    make: Callable[[Mapping[str, float]], Estimator] = boosted_from,
    clip: tuple[float, float] | None = CAPPED_CLIP,
) -> DataFrame:
    """(trial, params, mae, best_so_far, improved): mean fold MAE of every point, in order."""
    rows = []
    for trial, point in enumerate(points, 1):
        estimator = make(point)
        maes = cross_validate(df, fold, folds, lambda _train, e=estimator: e, clip).agg(F.avg("mae")).first()[0]
        rows.append((trial, json.dumps(dict(point), sort_keys=True), maes))
    return best_so_far(df.sparkSession.createDataFrame(rows, "trial int, params string, mae double"))


def penalties(trials: int = TRIALS, low: float = 1.0, high: float = 1e6) -> list[float]:
    """Ridge penalties at equal steps of their logarithm."""
    return [low * (high / low) ** (i / max(trials - 1, 1)) for i in range(trials)]


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold: str) -> dict[int, np.ndarray]:
    """For each fold the sums of all products of (1, features, label): one aggregate, a small matrix a fold."""
    columns = [F.lit(1.0), *[F.col(c).cast("double") for c in features], F.col(label)]
    size = len(columns)
    cells = [(i, j) for i in range(size) for j in range(i, size)]
    sums = df.groupBy(fold).agg(*[F.sum(columns[i] * columns[j]).alias(f"s{i}_{j}") for i, j in cells])
    out = {}
    for row in sums.collect():
        moments = np.zeros((size, size))
        for i, j in cells:
            moments[i, j] = moments[j, i] = row[f"s{i}_{j}"]
        out[row[fold]] = moments
    return out


def ridge_from_moments(moments: np.ndarray, alpha: float) -> np.ndarray:
    """Intercept and weights on raw features of a ridge with the penalty ``alpha * |w|²`` on standardised ones."""
    n = moments[0, 0]
    mean = moments[0, 1:] / n
    centred = moments[1:, 1:] - n * np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(centred)[:-1] / n, 0))
    scale[scale == 0] = 1.0
    gram = centred[:-1, :-1] / np.outer(scale, scale) + alpha * np.eye(len(scale))
    weights = np.linalg.lstsq(gram, centred[:-1, -1] / scale, rcond=None)[0] / scale
    return np.concatenate([[mean[-1] - weights @ mean[:-1]], weights])


def ridge_search(
    df: DataFrame,
    features: Sequence[str],
    fold: str,
    alphas: Sequence[float],
    label: str = "label",
    clip: tuple[float, float] | None = CAPPED_CLIP,
) -> DataFrame:
    """(trial, alpha, mae, best_so_far, improved): mean over the folds of each penalty's dollar MAE, in order.

    One pass sums the moments of every fold; the training moments of a fold are the sums of the others, so the
    models of all penalties and folds are solved from them. A second pass scores all rows under all penalties.
    """
    moments = fold_moments(df, features, label, fold)
    total = sum(moments.values())
    models_ = {k: [ridge_from_moments(total - own, a) for a in alphas] for k, own in moments.items()}
    # Every row meets the weights of its own fold: a literal of folds x penalties x features numbers.
    table = F.coalesce(*[F.when(F.col(fold) == k, F.array(*[F.array(*map(F.lit, w.tolist())) for w in fitted])) for k, fitted in models_.items()])
    rows = df.select(fold, F.col(label).alias("_y"), F.array(F.lit(1.0), *[F.col(c).cast("double") for c in features]).alias("_x"), table.alias("_w"))
    predicted = F.transform("_w", lambda w: F.aggregate(F.zip_with(w, "_x", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))
    rows = rows.select(fold, "_y", predicted.alias("_p"))
    error = lambda i: F.abs(F.exp("_y") - price_from_log(F.col("_p")[i], clip))
    per_fold = rows.groupBy(fold).agg(*[F.avg(error(i)).alias(f"m{i}") for i in range(len(alphas))])
    mean = per_fold.agg(*[F.avg(f"m{i}").alias(f"m{i}") for i in range(len(alphas))]).first()
    log = [(i + 1, float(a), mean[i]) for i, a in enumerate(alphas)]
    return best_so_far(df.sparkSession.createDataFrame(log, "trial int, alpha double, mae double"))


def best_so_far(trials: DataFrame) -> DataFrame:
    """Running minimum over the trial log (one row per trial)."""
    order = Window.partitionBy(F.lit(1)).orderBy("trial")
    earlier = F.min("mae").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return trials.withColumns({
        "best_so_far": F.min("mae").over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "improved": F.coalesce((F.col("mae") < earlier).cast("int"), F.lit(1)),
    })


def best_parameters(trials: DataFrame) -> dict[str, float]:
    return json.loads(trials.orderBy("mae", "trial").first()["params"])


def prefix_bounds(hashed: DataFrame, fractions: Sequence[float]) -> list[float | None]:
    """For each fraction the largest ``_hash`` of its part, none for all rows: one count and one quantile call for all."""
    total = hashed.count()
    # Half a rank past the last wanted row, so the bound falls between two hashes.
    probs = {f: min(1.0, (max(1, int(total * f)) - 0.5) / max(total - 1, 1)) for f in fractions if f < 1}
    wanted = sorted(set(probs.values()))
    found = column_quantiles(hashed.select("_hash"), ["_hash"], wanted) if wanted and total else {}
    at = dict(zip(wanted, found.get("_hash", [])))
    return [at.get(probs[f]) if f in probs else None for f in fractions]


def _prefix(hashed: DataFrame, bound: float | None) -> DataFrame:
    return hashed if bound is None else hashed.where(F.col("_hash") <= F.lit(bound).cast("double"))


def training_prefix(df: DataFrame, key: str, fraction: float, seed: int = SEED) -> DataFrame:
    """The fraction of rows whose key hashes lowest: nested subsets of exact size."""
    hashed = df.withColumn("_hash", key_number(F.col(key), seed))
    return _prefix(hashed, prefix_bounds(hashed, [fraction])[0]).drop("_hash")


def learning_curve(
    train: DataFrame,
    validation: DataFrame,
    key: str,
    make: Callable[[DataFrame], Estimator],
    fractions: Sequence[float] = CURVE_FRACTIONS,
    clip: tuple[float, float] | None = CAPPED_CLIP,
) -> DataFrame:
    """(fraction, n_train, train_mae, val_mae, gap) for growing parts of the training rows."""
    data = train.withColumn("_hash", key_number(F.col(key), SEED)).persist(StorageLevel.MEMORY_AND_DISK)
    parts = []
    for fraction, bound in zip(fractions, prefix_bounds(data, fractions)):
        part = _prefix(data, bound).drop("_hash")
        model = make(part).fit(part)
        seen = dollar_metrics(model.transform(part), clip=clip)
        unseen = dollar_metrics(model.transform(validation), clip=clip)
        row = seen.select(
            F.lit(float(fraction)).alias("fraction"), F.col("n").alias("n_train"), F.col("mae").alias("train_mae")
        )
        parts.append(row.withColumn("val_mae", unseen.select("mae").scalar()))
    curve = reduce(DataFrame.unionByName, parts)
    return settle(curve.withColumn("gap", F.col("val_mae") - F.col("train_mae")), data)


def curve_verdict(curve: DataFrame) -> DataFrame:
    """Final gap, gain from the first to the last size, and their labels."""
    return curve.agg(
        F.max_by("gap", "fraction").alias("final_gap"),
        (F.min_by("val_mae", "fraction") - F.max_by("val_mae", "fraction")).alias("gain"),
    ).withColumns({
        "fit_label": F.when(F.col("final_gap") > OVERFIT_GAP, "overfit").otherwise("healthy"),
        "data_label": F.when(F.col("gain") > STILL_IMPROVING, "more data helps").otherwise("plateau"),
    })
