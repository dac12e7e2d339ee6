"""Availability panels and review histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.operators import panel, recency
from hearthrate.session import spread
from suite.features import SENTIMENT_CTES, lexicon
from suite.registry import query, rounded, table

KEY, DATE = "l_partkey", "l_shipdate"
# Rows that agree on all of these have the same state, so their order does not matter.
TIES = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_returnflag"]


def blocked():
    return F.col("l_returnflag") == "R"


def available():
    return F.col("l_returnflag") != "R"


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem")


STREAK_CTES = """
f AS (SELECT l_partkey, (l_returnflag = 'R')::INTEGER AS b,
             lag((l_returnflag = 'R')::INTEGER) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_returnflag) AS p,
             row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_returnflag) AS i
      FROM lineitem),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR p <> b THEN 1 ELSE 0 END) OVER (PARTITION BY l_partkey ORDER BY i) AS run FROM f),
runs AS (SELECT l_partkey, run, max(b) AS b, count(*) AS len FROM g GROUP BY l_partkey, run),
streak AS (SELECT l_partkey, sum(len)::BIGINT AS dates, sum(CASE WHEN b = 1 THEN len ELSE 0 END)::BIGINT AS blocked_dates,
           count(CASE WHEN b = 1 THEN 1 END) AS streaks,
           coalesce(avg(CASE WHEN b = 1 THEN len END) / sum(len), 0.0) AS consecutive_blocked_rate
           FROM runs GROUP BY l_partkey)
"""
RATE_CTES = """
rates AS (SELECT l_partkey,
    avg((l_returnflag <> 'R')::INTEGER) AS overall_availability_rate,
    avg(CASE WHEN month(l_shipdate) IN (6, 7, 8) THEN (l_returnflag <> 'R')::INTEGER END) AS peak_availability_rate,
    avg(CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN (l_returnflag <> 'R')::INTEGER END) AS off_availability_rate,
    avg(CASE WHEN isodow(l_shipdate) IN (5, 6) THEN (l_returnflag <> 'R')::INTEGER END) AS pct_weekend_available,
    avg(l_linenumber) AS avg_minimum_nights_cal,
    (count(DISTINCT l_linenumber) > 1)::INTEGER AS has_dynamic_minimum,
    count(*) AS dates
  FROM lineitem GROUP BY l_partkey)
"""


@query("blocked_streak_rate", "W1 W2 A6 J8", "WITH " + STREAK_CTES + """
SELECT l_partkey, dates, blocked_dates, streaks, round(consecutive_blocked_rate, 9) AS consecutive_blocked_rate FROM streak
""")
def blocked_streak_rate(spark: SparkSession, sf: str) -> DataFrame:
    out = panel.blocked_streaks(lines(spark, sf), KEY, DATE, TIES, blocked())
    return rounded(out, "consecutive_blocked_rate", digits=9)


@query("blocked_streak_rate_split", "W1 W2 A6", "WITH " + STREAK_CTES + """
SELECT l_partkey, dates, blocked_dates, streaks, round(consecutive_blocked_rate, 9) AS consecutive_blocked_rate FROM streak
""")
def blocked_streak_rate_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same with every larger key handled as a hot one."""
    out = panel.blocked_streaks(lines(spark, sf), KEY, DATE, TIES, blocked(), chunk="day")
    return rounded(out, "consecutive_blocked_rate", digits=9)


@query("panel_rates", "F19 A1 A2 A3 A4 A5", "WITH " + RATE_CTES + """
SELECT *, off_availability_rate - peak_availability_rate AS availability_gap FROM rates
""")
def panel_rates(spark: SparkSession, sf: str) -> DataFrame:
    return panel.panel_rates(lines(spark, sf), KEY, DATE, available(), "l_linenumber")


@query("demand_scores", "A7 A8 S3 J2", "WITH " + RATE_CTES + """
SELECT l_partkey, round(p_retailprice * (1.0 - overall_availability_rate) * 365.0, 6) AS estimated_annual_revenue,
       round(p_retailprice * (1.0 - coalesce(peak_availability_rate, overall_availability_rate)), 6) AS peak_demand_score
FROM rates LEFT JOIN part ON p_partkey = l_partkey
""")
def demand_scores(spark: SparkSession, sf: str) -> DataFrame:
    rates = panel.panel_rates(lines(spark, sf), KEY, DATE, available(), "l_linenumber")
    prices = panel.price_lookup(table(spark, sf, "part"), "p_partkey", "p_retailprice", KEY)
    out = panel.demand_scores(rates.join(prices, KEY, "left"), F.col("price"))
    return rounded(out.select(KEY, "estimated_annual_revenue", "peak_demand_score"), "estimated_annual_revenue", "peak_demand_score")


# Supplier panels on the part table: most parts have no panel, so the fill has something to do.
_BY_SUPPLIER = (RATE_CTES + "," + STREAK_CTES).replace("l_suppkey, l_partkey", "TIES").replace("l_partkey", "l_suppkey").replace(
    "TIES", "l_suppkey, l_partkey"
)


@query("panel_features_joined", "A9 J2 J4 N6", "WITH " + _BY_SUPPLIER + """,
feat AS (SELECT l_suppkey, overall_availability_rate, peak_availability_rate, off_availability_rate,
    off_availability_rate - peak_availability_rate AS availability_gap, pct_weekend_available, avg_minimum_nights_cal,
    consecutive_blocked_rate, p_retailprice * (1.0 - overall_availability_rate) * 365.0 AS estimated_annual_revenue,
    p_retailprice * (1.0 - coalesce(peak_availability_rate, overall_availability_rate)) AS peak_demand_score, has_dynamic_minimum
  FROM rates JOIN streak USING (l_suppkey) LEFT JOIN part ON p_partkey = l_suppkey),
j AS (SELECT p_partkey, feat.* FROM part LEFT JOIN feat ON l_suppkey = p_partkey)
SELECT p_partkey, """ + ", ".join(
    f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM j)), 8) AS {c}" for c in panel.PANEL_NUMERIC
) + ", coalesce(has_dynamic_minimum, 0) AS has_dynamic_minimum FROM j")
def panel_features_joined(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    prices = panel.price_lookup(parts, "p_partkey", "p_retailprice", "l_suppkey")
    features = panel.panel_features(
        lines(spark, sf), "l_suppkey", DATE, TIES, available(), blocked(), "l_linenumber", prices
    )
    joined = panel.attach_panel_features(parts.select("p_partkey"), features, "p_partkey", "l_suppkey")
    return rounded(joined, *panel.PANEL_NUMERIC, digits=8)


RECENT_CTE = """
recent AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS recency FROM events
           QUALIFY recency <= 50)
"""


@query("recent_n", "W3 O1", "WITH " + RECENT_CTE + """
SELECT user_id, event_id, recency::INTEGER AS recency FROM recent
""")
def recent_n(spark: SparkSession, sf: str) -> DataFrame:
    return recency.recent_rows(table(spark, sf, "events"), "user_id", "ts", ["event_id"]).select(
        "user_id", "event_id", "recency"
    )


@query("recent_vs_all", "A11 A12 A13 J3", "WITH " + RECENT_CTE + """,
s AS (SELECT user_id, recency, (value - 50) / 50 AS compound, event_type FROM recent)
SELECT user_id, round(avg(compound), 9) AS avg_sentiment,
       round(avg(CASE WHEN recency <= 10 THEN compound END), 9) AS recent_sentiment,
       round(avg(CASE WHEN recency <= 10 THEN compound END) - avg(compound), 9) AS sentiment_trend,
       avg((compound > 0.05)::INTEGER) AS pct_positive_reviews, avg((compound < -0.05)::INTEGER) AS pct_negative_reviews,
       sum((event_type = 'click')::INTEGER)::INTEGER AS positive_keyword_count,
       sum((event_type = 'error')::INTEGER)::INTEGER AS negative_keyword_count
FROM s GROUP BY user_id
""")
def recent_vs_all(spark: SparkSession, sf: str) -> DataFrame:
    latest = recency.recent_rows(table(spark, sf, "events"), "user_id", "ts", ["event_id"])
    scored = latest.select(
        "user_id", "recency", ((F.col("value") - 50) / 50).alias("compound"),
        (F.col("event_type") == "click").cast("int").alias("has_praise"),
        (F.col("event_type") == "error").cast("int").alias("has_complaint"),
    )
    return rounded(recency.sentiment_by_key(scored, "user_id"), "avg_sentiment", "recent_sentiment", "sentiment_trend", digits=9)


@query("velocity", "A10 J8", """
WITH c AS (SELECT max(ts) - INTERVAL 7 DAY AS cutoff FROM events)
SELECT user_id, count(*) AS total, count(CASE WHEN ts >= cutoff THEN 1 END) AS recent,
       count(CASE WHEN ts >= cutoff THEN 1 END) / count(*)::DOUBLE AS review_velocity
FROM events, c GROUP BY user_id
""")
def velocity(spark: SparkSession, sf: str) -> DataFrame:
    return recency.review_velocity(
        table(spark, sf, "events"), "user_id", "ts", lambda latest: latest - F.make_dt_interval(F.lit(7))
    )


@query("velocity_12_months", "A10", """
WITH c AS (SELECT max(l_shipdate) - INTERVAL 12 MONTH AS cutoff FROM lineitem)
SELECT l_partkey, count(*) AS total, count(CASE WHEN l_shipdate >= cutoff THEN 1 END) AS recent,
       count(CASE WHEN l_shipdate >= cutoff THEN 1 END) / count(*)::DOUBLE AS review_velocity
FROM lineitem, c GROUP BY l_partkey
""")
def velocity_12_months(spark: SparkSession, sf: str) -> DataFrame:
    return recency.review_velocity(lines(spark, sf), KEY, DATE)


_REVIEWS = """
WITH talk AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS recency FROM conversations
              QUALIFY recency <= 50),
texts AS (SELECT conv_id * 1000 + recency AS id, conv_id, recency, text FROM talk),""" + SENTIMENT_CTES + """,
v AS (SELECT conv_id, count(CASE WHEN turn >= (SELECT max(turn) - 2 FROM conversations) THEN 1 END) / count(*)::DOUBLE AS review_velocity
      FROM conversations GROUP BY conv_id),
k AS (SELECT conv_id, avg(compound) AS a, avg(CASE WHEN recency <= 10 THEN compound END) AS r,
       avg((compound > 0.05)::INTEGER) AS pct_positive_reviews, avg((compound < -0.05)::INTEGER) AS pct_negative_reviews,
       sum(regexp_matches(lower(text), '\\b(?:clean|spacious|view|location|quiet|cozy|comfortable|beautiful|amazing|perfect)\\b')::INTEGER)::INTEGER AS positive_keyword_count,
       sum(regexp_matches(lower(text), '\\b(?:noisy|dirty|small|outdated|cold|disappointing|misleading|broken|smell|mold)\\b')::INTEGER)::INTEGER AS negative_keyword_count
      FROM texts JOIN compound USING (id) GROUP BY conv_id)
SELECT c_custkey, round(coalesce(a, 0), 8) AS avg_sentiment, round(coalesce(r, 0), 8) AS recent_sentiment,
       round(coalesce(r - a, 0), 8) AS sentiment_trend, coalesce(pct_positive_reviews, 0) AS pct_positive_reviews,
       coalesce(pct_negative_reviews, 0) AS pct_negative_reviews, coalesce(positive_keyword_count, 0) AS positive_keyword_count,
       coalesce(negative_keyword_count, 0) AS negative_keyword_count, coalesce(review_velocity, 0) AS review_velocity
FROM customer LEFT JOIN k ON conv_id = c_custkey LEFT JOIN v ON v.conv_id = c_custkey
"""


@query("review_features_joined", "A14 T1 T2 J2 N7", _REVIEWS)
def review_features_joined(spark: SparkSession, sf: str) -> DataFrame:
    talk = spread(table(spark, sf, "conversations"))
    features = recency.review_features(
        talk, "conv_id", "turn", ["role", "text"], "text", lexicon(spark), window=lambda latest: latest - 2
    )
    joined = recency.attach_review_features(table(spark, sf, "customer").select("c_custkey"), features, "c_custkey", "conv_id")
    return rounded(joined, "avg_sentiment", "recent_sentiment", "sentiment_trend", digits=8)
