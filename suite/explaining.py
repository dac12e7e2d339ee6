"""Attributions and importance stability."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.operators import attribution as A
from hearthrate.operators.models import boosted, draw_rows, fit_on_draw
from hearthrate.session import allow_checkpoints, cut_lineage, scratch_path, settle
from hearthrate.sources.artifacts import save_attributions
from suite.modelling import FEATURES, KEY_SQL, line_table, vectors
from suite.registry import query, rounded, table

WEIGHTS = {"l_quantity": 0.012, "l_discount": -1.5, "l_tax": 2.0, "l_linenumber": 0.03}
_MEANS = "m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in FEATURES) + " FROM lineitem)"
_PHI = {c: f"({w} * ({c} - m_{c}))" for c, w in WEIGHTS.items()}
_ID = KEY_SQL
# The SQL side numbers the rows, since two lines may share their key.
_ROWS = f"WITH {_MEANS}, n AS (SELECT *, row_number() OVER () AS uid FROM lineitem), a AS (" + " UNION ALL ".join(
    f"SELECT {_ID} AS id, uid, '{c}' AS feature, {p} AS v FROM n, m" for c, p in _PHI.items()
) + ")"


def linear_rows(spark: SparkSession, sf: str) -> DataFrame:
    return A.linear_attribution(line_table(spark, sf), "id", FEATURES, [WEIGHTS[c] for c in FEATURES], 4.0)


@query("linear_attribution", "G6 G11", f"""
WITH {_MEANS}
SELECT {_ID} AS id, {", ".join(f"round({p}, 9) AS {c}" for c, p in _PHI.items())},
       round(exp(least(greatest(4.0 + {" + ".join(f"{w} * m_{c}" for c, w in WEIGHTS.items())}, ln(1.0)), ln(1000.0))), 6) AS base_price
FROM lineitem, m
""")
def linear_attribution(spark: SparkSession, sf: str) -> DataFrame:
    rows = linear_rows(spark, sf)
    return rows.select(
        "id", *[F.round(F.col("phi")[i], 9).alias(c) for i, c in enumerate(FEATURES)],
        F.round(A.base_price(F.col("base")), 6).alias("base_price"),
    )


@query("attribution_summary", "G8 G9", f"""
WITH {_MEANS}, a AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(abs({p})) AS mean_abs, avg({p}) AS mean FROM lineitem, m" for c, p in _PHI.items()
) + """),
s AS (SELECT feature, mean_abs, mean_abs * 100 / sum(mean_abs) OVER () AS share_pct, (exp(mean_abs) - 1) * 100 AS impact_pct,
        row_number() OVER (ORDER BY mean_abs DESC, feature) AS rank FROM a),
g(grp, feature) AS (VALUES ('size', 'l_quantity'), ('size', 'l_linenumber'), ('rate', 'l_discount'), ('rate', 'l_tax'))
SELECT grp AS "group", feature, rank::INTEGER AS rank, round(mean_abs, 6) AS mean_abs, round(share_pct, 6) AS share_pct FROM s JOIN g USING (feature)
""")
def attribution_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = A.attribution_summary(linear_rows(spark, sf), FEATURES)
    groups = {"size": ["l_quantity", "l_linenumber"], "rate": ["l_discount", "l_tax"]}
    return rounded(A.group_callout(summary, groups), "mean_abs", "share_pct")


@query("row_top_k", "G10", _ROWS + """
SELECT id, feature, round(v, 9) AS attribution, row_number() OVER (PARTITION BY uid ORDER BY abs(v) DESC, feature)::INTEGER AS rank
FROM a QUALIFY rank <= 2
""")
def row_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.row_contributions(linear_rows(spark, sf), "id", FEATURES, 2), "attribution", digits=9)


@query("row_drivers", "G10", _ROWS + """
SELECT any_value(id) AS id, string_agg(feature || CASE WHEN v > 0 THEN ' (increases price)' ELSE ' (decreases price)' END, ', ' ORDER BY k) AS drivers
FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY abs(v) DESC, feature) AS k FROM a) WHERE k <= 3 GROUP BY uid
""")
def row_drivers(spark: SparkSession, sf: str) -> DataFrame:
    return A.driver_sentence(linear_rows(spark, sf), "id", FEATURES, 3)


@query("tree_attribution", "G7 G8 K2", f"""
SELECT '{'|'.join(sorted(FEATURES))}' AS features, count(*) AS n, count(*) AS additive, {len(FEATURES)} * count(*) AS saved FROM lineitem
""")
def tree_attribution(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows' attributions add up to the model's prediction, and how many cells of the saved matrix are read back."""
    allow_checkpoints(spark)
    rows = vectors(spark, sf, FEATURES).persist()
    model = fit_on_draw(boosted(), rows, "id")
    attributed = cut_lineage(A.tree_attribution(model.transform(rows).withColumn("both", F.struct("id", "prediction")), "both", FEATURES, model))
    path = scratch_path(spark, "attributions")
    save_attributions(attributed.select(F.col("both.id").alias("id"), "base", "phi"), "id", FEATURES, path)
    total = F.col("base") + F.aggregate("phi", F.lit(0.0), lambda a, x: a + x)
    out = attributed.agg(F.count(F.lit(1)).alias("n"), F.sum((F.abs(total - F.col("both.prediction")) < 1e-9).cast("long")).alias("additive"))
    saved = spark.read.parquet(path)
    names = F.array_join(F.array_sort(F.collect_set("feature")), "|")
    back = saved.agg(names.alias("features"), F.count("attribution").alias("saved"))
    return settle(out.withColumns({"saved": back.select("saved").scalar(), "features": back.select("features").scalar()}), rows)


@query("importance_stability", "G12 W5 U3 U4")
def importance_stability(spark: SparkSession, sf: str) -> DataFrame:
    """The models of all seeds are fitted on one draw of rows; every row is attributed under each."""
    allow_checkpoints(spark)
    # Nothing of the rows is kept between the passes, which read the four features alone.
    rows = line_table(spark, sf).select("id", *FEATURES)
    drawn = draw_rows(vectors(spark, sf, FEATURES).select("id", "label", "features"), "id").persist()
    parts = []
    for seed in A.STABILITY_SEEDS:
        model = fit_on_draw(boosted().setSeed(seed), drawn, "id")
        summary = A.attribution_summary(A.tree_attribution(rows, "id", FEATURES, model), FEATURES)
        parts.append(summary.select(F.lit(seed).alias("seed"), "feature", "mean_abs"))
    return settle(A.importance_stability(reduce(DataFrame.unionByName, parts)), drawn)


@query("importance_ranks", "G12 W5 U3 U4", """
WITH i AS (SELECT CASE l_linenumber % 5 WHEN 0 THEN 42 WHEN 1 THEN 7 WHEN 2 THEN 123 WHEN 3 THEN 2024 ELSE 999 END AS seed,
             'f' || (l_suppkey % 25)::VARCHAR AS feature, round(avg(l_quantity), 1) AS mean_abs FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, (rank() OVER (PARTITION BY seed ORDER BY mean_abs DESC) + (count(*) OVER (PARTITION BY seed, mean_abs) - 1) / 2.0) AS avg_rank,
        row_number() OVER (PARTITION BY seed ORDER BY mean_abs DESC, feature) AS place,
        CASE seed WHEN 42 THEN 0 WHEN 7 THEN 1 WHEN 123 THEN 2 WHEN 2024 THEN 3 ELSE 4 END AS o FROM i),
k AS (SELECT *, floor(avg_rank)::INTEGER AS rank FROM r),
w AS (SELECT feature, min(CASE WHEN place <= 10 THEN o * 100 + place END) AS first, """ + ", ".join(
    f"max(CASE WHEN seed = {s} THEN rank END) AS seed_{s}" for s in A.STABILITY_SEEDS
) + """, avg(rank) AS mean_rank, stddev_samp(rank) AS rank_std FROM k GROUP BY feature)
SELECT feature, seed_42, seed_7, seed_123, seed_2024, seed_999, round(mean_rank, 6) AS mean_rank, round(rank_std, 6) AS rank_std,
       (rank_std < 3)::INTEGER AS stable FROM w WHERE first IS NOT NULL ORDER BY first LIMIT 15
""")
def importance_ranks(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber") % 5
    seed = F.coalesce(*[F.when(line == i, s) for i, s in enumerate(A.STABILITY_SEEDS)])
    importances = table(spark, sf, "lineitem").groupBy(
        seed.alias("seed"), F.concat(F.lit("f"), F.col("l_suppkey") % 25).alias("feature")
    ).agg(F.round(F.avg("l_quantity"), 1).alias("mean_abs"))
    return rounded(A.importance_stability(importances), "mean_rank", "rank_std")
