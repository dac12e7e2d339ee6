"""Scalar features and text flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.functions import geo, parsing, wording
from hearthrate.functions.nulls import clamp, flag
from hearthrate.functions.pricing import log_price, price_from_log
from hearthrate.operators.features import activity_features, interaction_features, listing_features, text_features
from hearthrate.operators.profile import flag_coverage
from hearthrate.operators.sentiment import NEGATORS, STRENGTHENERS, WEAKENERS, score_sentiment
from hearthrate.operators.sparse import SparseEncoder
from hearthrate.session import scratch_path, spread
from hearthrate.sources.tables import read_dimension, write_delimited
from suite.registry import query, rounded, table


@query("json_count", "F1", """
WITH t AS (
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN '["Wifi", "Hot tub", ' || '"' || event_type || '"]'
                                     WHEN 1 THEN props WHEN 2 THEN event_type || ', b, c'
                                     WHEN 3 THEN ' ' ELSE NULL END AS text FROM events)
SELECT event_id, (CASE event_id % 5 WHEN 0 THEN 3 WHEN 1 THEN len(json_keys(text)) WHEN 2 THEN len(string_split(text, ','))
                               ELSE 0 END)::INTEGER AS items FROM t
""")
def json_count(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, F.concat(F.lit('["Wifi", "Hot tub", "'), F.col("event_type"), F.lit('"]')))
        .when(kind == 1, F.col("props"))
        .when(kind == 2, F.concat(F.col("event_type"), F.lit(", b, c")))
        .when(kind == 3, " ")
    )
    return table(spark, sf, "events").select("event_id", parsing.json_item_count(text).alias("items"))


@query("date_gaps", "F2 F8", """
SELECT o_orderkey, round(date_diff('day', o_orderdate::DATE, DATE '2002-01-01') / 365.25, 9) AS years,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE date_diff('day', o_orderdate::DATE, DATE '2002-01-01') END::INTEGER AS days
FROM orders
""")
def date_gaps(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 13 == 0, "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    end = parsing.day(F.lit("2002-01-01"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.round(parsing.years_between(end, F.to_date("o_orderdate")), 9).alias("years"),
        parsing.days_between(end, parsing.day(text)).alias("days"),
    )


@query("flag_parse", "F3 F7", """
SELECT l_orderkey, l_linenumber, l_partkey, count(*) AS n,
       max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS yes_flag,
       max(CASE WHEN NULLIF(l_linenumber % 3, 1) > 0 THEN 1 ELSE 0 END) AS active
FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey
""")
def flag_parse(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("l_returnflag") == "R", "t").when(F.col("l_returnflag") == "A", "f")
    recent = F.nullif(F.col("l_linenumber") % 3, F.lit(1))
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(parsing.yes(text)).alias("yes_flag"),
        F.max(flag(recent > 0)).alias("active"),
    )


@query("percent_parse", "F4 F6 F18", """
SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE (c_custkey % 101)::DOUBLE END AS rate,
       (c_custkey % 366) / 365.0 AS availability,
       greatest(least(c_acctbal / 5000.0, 1.0), 0.0) AS clipped
FROM customer
""")
def percent_parse(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    text = F.when(key % 6 == 0, "n/a").otherwise(F.concat((key % 101).cast("string"), F.lit("% ")))
    return table(spark, sf, "customer").select(
        "c_custkey",
        parsing.percent(text).alias("rate"),
        ((key % 366) / 365.0).alias("availability"),
        clamp(F.col("c_acctbal") / 5000.0, 0.0, 1.0).alias("clipped"),
    )


@query("row_mean", "F5 F9 F10", """
WITH t AS (SELECT l_returnflag, l_linestatus, l_partkey,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS a,
    CASE WHEN l_linenumber <= 2 THEN NULL ELSE l_linenumber::DOUBLE END AS b,
    CASE WHEN l_linenumber % 2 = 1 THEN NULL ELSE l_suppkey::DOUBLE END AS c FROM lineitem),
m AS (SELECT *, (coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0))
       / NULLIF((a IS NOT NULL)::INTEGER + (b IS NOT NULL)::INTEGER + (c IS NOT NULL)::INTEGER, 0) AS mean FROM t)
SELECT l_partkey, count(mean) AS n, round(avg(mean), 5) AS mean, round(sum(a * b), 4) AS product,
       round(sum((l_returnflag = 'R')::INTEGER * mean), 4) AS flagged
FROM m GROUP BY l_partkey
""")
def row_mean(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber")
    t = table(spark, sf, "lineitem").select(
        "l_partkey", "l_returnflag",
        F.when(line != 1, F.col("l_quantity")).alias("a"),
        F.when(line > 2, line.cast("double")).alias("b"),
        F.when(line % 2 == 0, F.col("l_suppkey").cast("double")).alias("c"),
    )
    mean = parsing.row_mean([F.col("a"), F.col("b"), F.col("c")])
    out = t.withColumn("m", mean).groupBy("l_partkey").agg(
        F.count("m").alias("n"), F.round(F.avg("m"), 5).alias("mean"),
        F.round(F.sum(F.col("a") * F.col("b")), 4).alias("product"),
        F.round(F.sum(flag(F.col("l_returnflag") == "R") * F.col("m")), 4).alias("flagged"),
    )
    return out


@query("distance_to_point", "F11 F12", """
WITH p AS (SELECT c_custkey, 47.0 + (c_custkey % 1000) / 1000.0 AS lat,
           CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE -122.0 - (c_custkey % 700) / 1000.0 END AS lon FROM customer)
SELECT c_custkey, CASE WHEN lon IS NOT NULL THEN round(2 * 6371.0 * asin(least(1.0, sqrt(
    pow(sin(radians(47.6062 - lat) / 2), 2)
    + cos(radians(lat)) * cos(radians(47.6062)) * pow(sin(radians(-122.3321 - lon) / 2), 2)))), 6) END AS km
FROM p
""")
def distance_to_point(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    lat = F.lit(47.0) + (key % 1000) / 1000.0
    lon = F.when(key % 50 != 0, F.lit(-122.0) - (key % 700) / 1000.0)
    return table(spark, sf, "customer").select("c_custkey", F.round(geo.distance_to(lat, lon), 6).alias("km"))


_FLAGS = {**wording.DESCRIPTION_PATTERNS, **wording.AMENITY_PATTERNS}
# Listing wording placed in front of the whole text, so that every flag occurs.
_OPENERS = (
    "Scenic view and HOT TUB", "waterfront, high-end parking", "downtown gym; ev charger", "cozy fireplace & patio",
    "newly renovated pool", "private entrance on the top floor",
)
_OPENER_SQL = "CASE doc_id % 7 " + " ".join(f"WHEN {i} THEN '{t}. '" for i, t in enumerate(_OPENERS)) + " ELSE '' END"


@query("keyword_flags", "F13 F14 F15 P9", f"""
WITH d AS (SELECT lower({_OPENER_SQL} || text) AS about, lower(coalesce(source, '') || ' ' || {_OPENER_SQL}) AS items FROM documents),
f AS (SELECT """ + ", ".join(
    f"regexp_matches({'items' if n in wording.AMENITY_PATTERNS else 'about'}, '{p}')::INTEGER AS {n}" for n, p in _FLAGS.items()
) + " FROM d) " + " UNION ALL ".join(
    f"SELECT '{n}' AS flag, sum({n})::BIGINT AS rows_set, round(sum({n}) * 100.0 / count(*), 6) AS pct FROM f" for n in _FLAGS))
def keyword_flags(spark: SparkSession, sf: str) -> DataFrame:
    opener = F.lit("")
    for i, text in enumerate(_OPENERS):
        opener = F.when(F.col("doc_id") % 7 == i, f"{text}. ").otherwise(opener)
    docs = spread(table(spark, sf, "documents")).select(
        F.concat(opener, "text").alias("description"),
        F.concat(F.coalesce("source", F.lit("")), F.lit(" "), opener).alias("amenities"),
    )
    return rounded(flag_coverage(text_features(docs), list(_FLAGS)), "pct")


@query("log_price_scale", "F17", """
SELECT o_orderkey, round(ln(o_totalprice / 900.0), 9) AS log_price,
       round(exp(least(greatest(ln(o_totalprice / 100.0), ln(1.0)), ln(1000.0))), 6) AS price
FROM orders
""")
def log_price_scale(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.round(log_price(price / 900.0), 9).alias("log_price"),
        F.round(price_from_log(log_price(price / 100.0)), 6).alias("price"),
    )


# A toy lexicon of words that occur in the documents.
LEXICON = (("the", 1.3), ("is", -1.1), ("la", 2.0), ("der", -2.4), ("and", 0.9), ("de", 0.7), ("ement", 1.9))


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "word string, valence double")


def _in(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


PHRASE_CASES = {
    1: "",
    2: "WHEN two = 'never' AND one IN ('so', 'this') THEN 1.25 WHEN two = 'without' AND one = 'doubt' THEN 1.0",
    3: """WHEN plain AND ((three = 'never' AND two IN ('so', 'this')) OR one IN ('so', 'this')) THEN 1.25
      WHEN three = 'without' AND (two = 'doubt' OR one = 'doubt') THEN 1.0""",
}


def sentiment_ctes(lexicon_rows) -> str:
    values = ", ".join(f"('{w}', {v}::DOUBLE)" for w, v in lexicon_rows)
    return f"""
lex(word, valence) AS (VALUES {values}),
w0 AS (SELECT id, text, unnest(string_split_regex(text, '[ \\t\\n\\f\\r\\v]+')) AS raw,
              generate_subscripts(string_split_regex(text, '[ \\t\\n\\f\\r\\v]+'), 1) AS pos FROM texts),
w1 AS (SELECT id, text, pos, regexp_replace(regexp_replace(raw, '^[!-/:-@\\[-`{{-~]+', ''), '[!-/:-@\\[-`{{-~]+$', '') AS word FROM w0),
w2 AS (SELECT id, word, row_number() OVER (PARTITION BY id ORDER BY pos) AS i FROM w1 WHERE length(word) > 1),
w3 AS (SELECT *, lower(word) AS low, (upper(word) = word AND lower(word) <> word) AS shout,
    lag(word, 1) OVER o AS r1, lag(word, 2) OVER o AS r2, lag(word, 3) OVER o AS r3,
    lower(lag(word, 1) OVER o) AS one, lower(lag(word, 2) OVER o) AS two, lower(lag(word, 3) OVER o) AS three, lower(lead(word) OVER o) AS after
  FROM w2 WINDOW o AS (PARTITION BY id ORDER BY i)),
per_text AS (SELECT id, bool_or(shout) AND NOT bool_and(shout) AS mixed, min(CASE WHEN low = 'but' THEN i END) AS but FROM w3 GROUP BY id),
s0 AS (SELECT w3.*, mixed, but, valence + CASE WHEN mixed AND shout THEN CASE WHEN valence > 0 THEN 0.733 ELSE -0.733 END ELSE 0.0 END AS s,
    three IS NOT NULL AND three NOT IN (SELECT word FROM lex) AS plain
  FROM w3 JOIN lex ON lex.word = w3.low JOIN per_text USING (id) WHERE NOT (low = 'kind' AND coalesce(after, '') = 'of')),
""" + "".join(f"""
s{d} AS (SELECT * EXCLUDE (s), (s + coalesce(((CASE WHEN lower(r{d}) IN {_in(STRENGTHENERS)} THEN 0.293
    WHEN lower(r{d}) IN {_in(WEAKENERS)} THEN -0.293 END) * (CASE WHEN s < 0 THEN -1.0 ELSE 1.0 END)
    + CASE WHEN mixed AND upper(r{d}) = r{d} AND lower(r{d}) <> r{d} THEN CASE WHEN s > 0 THEN 0.733 ELSE -0.733 END ELSE 0.0 END) * {damping}, 0.0))
    * CASE {PHRASE_CASES[d]} WHEN lower(r{d}) IN {_in(NEGATORS)} OR contains(lower(r{d}), 'n''t') THEN -0.74 ELSE 1.0 END AS s FROM s{d - 1}),
""" for d, damping in ((1, 1.0), (2, 0.95), (3, 0.9))) + """
s4 AS (SELECT * EXCLUDE (s), (s - CASE WHEN plain AND concat(three, ' ', two) IN ('kind of', 'sort of', 'just enough') THEN 0.293 ELSE 0.0 END
      - CASE WHEN plain AND concat(two, ' ', one) IN ('kind of', 'sort of', 'just enough') THEN 0.293 ELSE 0.0 END)
    * CASE WHEN one = 'least' AND coalesce(two, '') NOT IN ('at', 'very') THEN -0.74 ELSE 1.0 END AS s FROM s3),
sums AS (SELECT id, sum(s * CASE WHEN but IS NULL OR i = but THEN 1.0 WHEN i < but THEN 0.5 ELSE 1.5 END) AS s FROM s4 GROUP BY id),
marks AS (SELECT id, length(text) - length(replace(text, '!', '')) AS bangs, length(text) - length(replace(text, '?', '')) AS asks FROM texts),
loud AS (SELECT marks.id, coalesce(s, 0.0) AS s, least(bangs, 4) * 0.292
    + CASE WHEN asks <= 1 THEN 0.0 WHEN asks <= 3 THEN asks * 0.18 ELSE 0.96 END AS e FROM marks LEFT JOIN sums USING (id)),
raised AS (SELECT id, s + CASE WHEN s > 0 THEN e WHEN s < 0 THEN -e ELSE 0.0 END AS s FROM loud),
compound AS (SELECT id, round(s / sqrt(s * s + 15.0), 4) AS compound FROM raised)
"""


SENTIMENT_CTES = sentiment_ctes(LEXICON)


@query("sentiment_scores", "T1 T2", """
WITH texts AS (SELECT doc_id AS id, text FROM documents),""" + SENTIMENT_CTES + """
SELECT doc_id, compound,
       regexp_matches(lower(text), '\\b(?:""" + "|".join(wording.PRAISE_WORDS) + """)\\b')::INTEGER AS praise,
       regexp_matches(lower(text), '\\b(?:""" + "|".join(wording.COMPLAINT_WORDS) + """)\\b')::INTEGER AS complaint
FROM documents JOIN compound ON id = doc_id
""")
def sentiment_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", "text",
        wording.mentions_any(F.col("text"), wording.PRAISE_WORDS).alias("praise"),
        wording.mentions_any(F.col("text"), wording.COMPLAINT_WORDS).alias("complaint"),
    )
    return score_sentiment(docs, ["doc_id", "praise", "complaint"], "text", lexicon(spark))


# Reviews written from the columns of orders: seven words of this list each, so that every phrase of the rules occurs.
REVIEW_WORDS = ("never", "so", "this", "without", "doubt", "least", "at", "very", "kind", "of", "sort", "just", "enough", "couldn't", "stay", "GREAT", "bad", "clean", "but")
REVIEW_LEXICON = (("great", 3.1), ("bad", -2.5), ("clean", 1.7), ("kind", 2.4))
_PICKS = (3, 5, 7, 11, 13, 17, 23)


@query("phrase_sentiment", "T1", "WITH texts AS (SELECT o_orderkey AS id, concat_ws(' ', " + ", ".join(
    f"([{', '.join(chr(39) + w.replace(chr(39), chr(39) * 2) + chr(39) for w in REVIEW_WORDS)}])[(o_orderkey * {m} + o_custkey // {m}) % {len(REVIEW_WORDS)} + 1]" for m in _PICKS
) + ") AS text FROM orders)," + sentiment_ctes(REVIEW_LEXICON) + "SELECT id AS o_orderkey, compound FROM compound")
def phrase_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    words = F.array(*[F.lit(w) for w in REVIEW_WORDS])
    picked = [F.get(words, ((F.col("o_orderkey") * m + F.floor(F.col("o_custkey") / m)) % len(REVIEW_WORDS)).cast("int")) for m in _PICKS]
    reviews = table(spark, sf, "orders").select("o_orderkey", F.concat_ws(" ", *picked).alias("text"))
    return score_sentiment(reviews, ["o_orderkey"], "text", spark.createDataFrame(REVIEW_LEXICON, "word string, valence double"))


@query("listing_activity", "F5 F6 F7 F8 F9 F10", """
SELECT l_orderkey, l_linenumber, round(l_suppkey % 366 / 365.0, 9) AS availability_rate, coalesce(l_linenumber > 3, false)::INTEGER AS reviews_active,
       date_diff('day', l_shipdate::DATE, DATE '1999-01-01')::INTEGER AS days_since_last_review, round((l_tax * 10 + l_discount * 10) / 2, 9) AS review_score_avg,
       round(l_quantity * l_tax * 10, 9) AS size_quality_score, round((l_returnflag = 'R')::INTEGER * (l_tax * 10 + l_discount * 10) / 2, 9) AS host_quality_score
FROM lineitem
""")
def listing_activity(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_suppkey") % 366).alias("availability_365"), (F.col("l_linenumber") - 3).alias("number_of_reviews_l30d"),
        F.lit("1999-01-01").alias("last_scraped"), F.col("l_shipdate").cast("date").cast("string").alias("last_review"),
        (F.col("l_tax") * 10).alias("review_scores_rating"), (F.col("l_discount") * 10).alias("review_scores_value"),
        F.col("l_quantity").alias("accommodates"), (F.col("l_returnflag") == "R").cast("int").alias("is_superhost"),
    )
    made = lines.transform(activity_features).transform(interaction_features)
    names = ("availability_rate", "review_score_avg", "size_quality_score", "host_quality_score")
    return rounded(made.select("l_orderkey", "l_linenumber", "reviews_active", "days_since_last_review", *names), *names, digits=9)


_LISTED = {
    "price": "c_acctbal + 1000.0e0", "amenities": """CASE c_custkey % 3 WHEN 0 THEN '["a", "b"]' WHEN 1 THEN '[]' END""",
    "host_is_superhost": "CASE WHEN c_custkey % 2 = 0 THEN 't' ELSE 'f' END", "host_response_rate": "concat(c_custkey % 101, '%')",
    "host_acceptance_rate": "concat(c_custkey % 97, '%')", "instant_bookable": "CASE WHEN c_custkey % 5 = 0 THEN 't' END",
    "host_has_profile_pic": "'t'", "host_identity_verified": "'f'",
    "review_scores_rating": "CASE WHEN c_custkey % 7 > 0 THEN (c_custkey % 50) / 10.0e0 END", "review_scores_value": "(c_custkey % 40) / 10.0e0",
    "availability_365": "c_custkey % 366", "number_of_reviews_l30d": "c_custkey % 4", "accommodates": "c_custkey % 8 + 1",
    "latitude": "47 + (c_custkey % 100) / 100.0e0", "longitude": "-122 - (c_custkey % 50) / 100.0e0",
}
_LISTED_SQL = ", ".join(f"{e.replace('e0', '::DOUBLE')} AS {c}" for c, e in _LISTED.items())


@query("listing_pipeline", "F16 S4 J1 W4", f"""
WITH l AS (SELECT c_custkey AS id, n_name AS area, r_name AS neighbourhood_group, {_LISTED_SQL},
    CASE WHEN c_custkey % 11 > 0 THEN DATE '2010-01-01' + (c_custkey % 4000)::INTEGER END AS since, DATE '2023-01-01' + (c_custkey % 500)::INTEGER AS reviewed
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey),
s AS (SELECT *, CASE WHEN review_scores_rating IS NULL THEN review_scores_value ELSE (review_scores_rating + review_scores_value) / 2 END AS score FROM l)
SELECT id, CASE id % 3 WHEN 0 THEN 2 ELSE 0 END AS amenities_count, round((DATE '2024-06-30' - since) / 365.25::DOUBLE, 6) AS host_experience_years,
  (host_is_superhost = 't')::INTEGER AS is_superhost, round(score, 6) AS review_score_avg, round(availability_365 / 365.0::DOUBLE, 6) AS availability_rate,
  (number_of_reviews_l30d > 0)::INTEGER AS reviews_active, DATE '2024-06-30' - reviewed AS days_since_last_review,
  round(accommodates * review_scores_rating, 6) AS size_quality_score, round((host_is_superhost = 't')::INTEGER * score, 6) AS host_quality_score,
  round(2 * 6371 * asin(least(1, sqrt(pow(sin(radians(47.6062 - latitude) / 2), 2)
    + cos(radians(latitude)) * cos(radians(47.6062)) * pow(sin(radians(-122.3321 - longitude) / 2), 2)))), 6) AS distance_to_downtown,
  neighbourhood_group, round(avg(price) OVER (PARTITION BY area), 6) AS neighbourhood_avg_price,
  round(avg(price) OVER (PARTITION BY neighbourhood_group), 6) AS neighbourhood_group_avg_price
FROM s
""")
def listing_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as listings through all structured features; areas are written as CSV and read as a dimension."""
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    path = scratch_path(spark, "areas")
    areas = nations.join(regions, F.col("r_regionkey") == F.col("n_regionkey"))
    write_delimited(areas.select(F.col("r_name").alias("neighbourhood_group"), F.col("n_name").alias("neighbourhood")), path)
    named = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    day = lambda start, span: F.date_add(F.lit(start).cast("date"), (F.col("c_custkey") % span).cast("int")).cast("string")
    listings = named.select(
        F.col("c_custkey").alias("id"), F.col("n_name").alias("neighbourhood_cleansed"), *[F.expr(e).alias(c) for c, e in _LISTED.items()],
        F.lit("2024-06-30").alias("last_scraped"), F.when(F.col("c_custkey") % 11 > 0, day("2010-01-01", 4000)).alias("host_since"), day("2023-01-01", 500).alias("last_review"),
    )
    featured = listing_features(listings, read_dimension(spark, path))
    exact = ["id", "amenities_count", "is_superhost", "reviews_active", "days_since_last_review", "neighbourhood_group"]
    near = ["host_experience_years", "review_score_avg", "availability_rate", "size_quality_score", "host_quality_score", "distance_to_downtown",
            "neighbourhood_avg_price", "neighbourhood_group_avg_price"]
    return rounded(featured.select(*exact, *near), *near)


@query("one_hot_sparse", "M3", """
WITH t AS (SELECT c_custkey, c_mktsegment AS a, CASE WHEN c_custkey % 9 > 0 THEN c_name END AS b FROM customer),
a AS (SELECT a, row_number() OVER (ORDER BY a) - 1 AS place FROM (SELECT DISTINCT a FROM t)),
b AS (SELECT b, row_number() OVER (ORDER BY b) - 1 AS place FROM (SELECT DISTINCT b FROM t WHERE b IS NOT NULL)),
n AS (SELECT (SELECT count(*) - 1 FROM a) AS na, (SELECT count(*) - 1 FROM b) AS nb)
SELECT c_custkey, (na + nb)::INTEGER AS width, ((coalesce(a.place, 0) > 0)::INTEGER + (coalesce(b.place, 0) > 0)::INTEGER)::DOUBLE AS hot,
  (CASE WHEN a.place > 0 THEN a.place ELSE 0 END + CASE WHEN b.place > 0 THEN na + b.place ELSE 0 END)::DOUBLE AS places
FROM t LEFT JOIN a USING (a) LEFT JOIN b USING (b), n
""")
def one_hot_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Segments and names, a category for each customer, as one sparse vector: its width, its ones and the sum of their places."""
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("a"), F.when(F.col("c_custkey") % 9 > 0, F.col("c_name")).alias("b"))
    encoded = SparseEncoder.fit(rows, ["a", "b"]).transform(rows)
    # The sparse vector's own indices, from its JSON form, so that no dense array is made.
    parts = F.from_json(F.to_json(F.struct("features")), "features struct<type int, size int, indices array<int>, values array<double>>")["features"]
    total = F.aggregate(parts["indices"], F.lit(0.0), lambda s, i: s + i + 1)
    return encoded.select("c_custkey", parts["size"].alias("width"), F.aggregate(parts["values"], F.lit(0.0), lambda s, v: s + v).alias("hot"), total.alias("places"))
