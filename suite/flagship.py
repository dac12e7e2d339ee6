"""The flagship: parts as listings with panel and recency features, confidence tier and price range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.functions.pricing import confidence_tier, range_high, range_low
from hearthrate.operators import panel, recency
from suite.panels import DATE, KEY, RATE_CTES, STREAK_CTES, TIES, available, blocked, lines
from suite.registry import query, rounded, table
from suite.scoring import HALF_SQL, TIER_SQL

_FILLED = ", ".join(
    f"round(CASE WHEN absent > 0 THEN coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM j)) ELSE {c} END, 6) AS {c}"
    for c in panel.PANEL_NUMERIC
)


@query("flagship", "A9 A10 J2 J4 N6 G1 G2", "WITH " + RATE_CTES + "," + STREAK_CTES + f""",
feat AS (SELECT l_partkey, overall_availability_rate, peak_availability_rate, off_availability_rate,
    off_availability_rate - peak_availability_rate AS availability_gap, pct_weekend_available, avg_minimum_nights_cal,
    consecutive_blocked_rate, p_retailprice * (1.0 - overall_availability_rate) * 365.0 AS estimated_annual_revenue,
    p_retailprice * (1.0 - coalesce(peak_availability_rate, overall_availability_rate)) AS peak_demand_score, has_dynamic_minimum
  FROM rates JOIN streak USING (l_partkey) LEFT JOIN part ON p_partkey = l_partkey),
j AS (SELECT p_partkey, p_retailprice, feat.* FROM part LEFT JOIN feat ON l_partkey = p_partkey),
a AS (SELECT count(*) AS absent FROM j WHERE overall_availability_rate IS NULL),
top AS (SELECT max(l_shipdate) AS newest, max(l_shipdate) - INTERVAL 12 MONTH AS cutoff FROM lineitem),
act AS (SELECT l_partkey AS k, count(*) AS total, count(CASE WHEN l_shipdate >= cutoff THEN 1 END) AS recent,
          date_diff('day', max(l_shipdate)::DATE, max(newest)::DATE)::INTEGER AS dslr FROM lineitem, top GROUP BY l_partkey),
s AS (SELECT j.*, absent, total, recent, dslr, coalesce(total, 0) AS n_reviews, p_retailprice / 10 AS price FROM j CROSS JOIN a LEFT JOIN act ON k = p_partkey)
SELECT p_partkey, p_retailprice, {_FILLED}, coalesce(has_dynamic_minimum, 0) AS has_dynamic_minimum, total, recent,
       recent / total::DOUBLE AS review_velocity, dslr AS days_since_last, {TIER_SQL} AS confidence_tier,
       round_even(price - {HALF_SQL.format(p='price')}, 2) AS price_range_low, round_even(price + {HALF_SQL.format(p='price')}, 2) AS price_range_high
FROM s
""")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    calendar = lines(spark, sf)
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    features = panel.panel_features(
        calendar, KEY, DATE, TIES, available(), blocked(), "l_linenumber",
        panel.price_lookup(parts, "p_partkey", "p_retailprice", KEY),
    )
    joined = panel.attach_panel_features(parts, features, "p_partkey", KEY)
    newest = calendar.agg(F.to_date(F.max(DATE))).scalar()
    last = calendar.groupBy(KEY).agg(F.datediff(newest, F.to_date(F.max(DATE))).alias("days_since_last"))
    activity = recency.review_velocity(calendar, KEY, DATE).join(last, KEY).withColumnRenamed(KEY, "p_partkey")
    price = F.col("p_retailprice") / 10
    scored = joined.join(activity, "p_partkey", "left").withColumns({
        "confidence_tier": confidence_tier(F.col("days_since_last"), F.coalesce("total", F.lit(0))),
        "price_range_low": range_low(price),
        "price_range_high": range_high(price),
    })
    return rounded(scored, *panel.PANEL_NUMERIC)
