"""Null policy, encoding, splits and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.functions.keyed import fold_of, split_side
from hearthrate.operators import design, selection
from hearthrate.operators.clean import drop_columns
from hearthrate.operators.impute import NullPolicy, column_mode, fill_values
from suite.registry import query, rounded, table

HOSTS_SQL = """
SELECT o_orderkey, CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderpriority END AS host_name,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS host_location,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 't' END AS host_is_superhost,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS beds,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice / 7 END AS reviews_per_month,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_custkey END AS days_since_last_review,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS bathrooms_text
FROM orders
"""


def hosts(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 23 != 0, F.col("o_orderpriority")).alias("host_name"),
        F.when(key % 4 != 0, F.col("o_orderstatus")).alias("host_location"),
        F.when(key % 6 != 0, "t").alias("host_is_superhost"),
        F.when(key % 5 != 0, F.col("o_totalprice")).alias("beds"),
        F.when(key % 7 != 0, F.col("o_totalprice") / 7).alias("reviews_per_month"),
        F.when(key % 8 != 0, F.col("o_custkey")).alias("days_since_last_review"),
        F.when(key % 9 != 0, F.col("o_orderpriority")).alias("bathrooms_text"),
        F.col("o_orderdate").alias("last_review"),
        F.col("o_orderstatus").alias("neighbourhood"),
    )


@query("impute_policy", "N1 N2 N3 N4 N5 N9 N10", f"""
WITH h AS ({HOSTS_SQL}), k AS (SELECT * FROM h WHERE host_name IS NOT NULL)
SELECT o_orderkey, host_name, coalesce(host_location, 'unknown') AS host_location,
       coalesce(host_is_superhost, 'f') AS host_is_superhost,
       round(coalesce(beds, (SELECT quantile_cont(beds, 0.5) FROM k)), 6) AS beds,
       round(coalesce(reviews_per_month, 0), 6) AS reviews_per_month,
       coalesce(days_since_last_review, 9999)::DOUBLE AS days_since_last_review,
       coalesce(bathrooms_text, (SELECT bathrooms_text FROM k WHERE bathrooms_text IS NOT NULL GROUP BY 1
                                 ORDER BY count(*) DESC, bathrooms_text LIMIT 1)) AS bathrooms_text
FROM k
""")
def impute_policy(spark: SparkSession, sf: str) -> DataFrame:
    rows = hosts(spark, sf)
    return rounded(NullPolicy.fit(rows).transform(rows), "beds", "reviews_per_month")


@query("mode_fill", "N4", """
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS kind FROM part)
SELECT p_partkey, coalesce(kind, (SELECT kind FROM p WHERE kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1)) AS kind
FROM p
""")
def mode_fill(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("kind"))
    return fill_values(parts, {"kind": column_mode(parts, "kind")})


@query("drop_listing_columns", "C9 C10 N9 M1", "SELECT o_orderkey, o_totalprice, o_custkey AS host_id FROM orders")
def drop_listing_columns(spark: SparkSession, sf: str) -> DataFrame:
    from hearthrate.operators.clean import TARGET_DERIVED_COLUMNS, UNINFORMATIVE_COLUMNS

    wide = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_custkey").alias("host_id"), F.col("o_orderpriority").alias("listing_url"),
        F.col("o_orderdate").alias("last_scraped"), (F.col("o_totalprice") * 2).alias("peak_demand_score"),
        F.col("o_orderstatus").alias("host_name"),
    )
    return drop_columns(wide, [*UNINFORMATIVE_COLUMNS, *TARGET_DERIVED_COLUMNS, *design.LEFT_OUT])


@query("bucket_topn", "M2 O4", """
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_brand END AS brand FROM part),
top AS (SELECT brand FROM t WHERE brand IS NOT NULL GROUP BY brand ORDER BY count(*) DESC, brand LIMIT 10)
SELECT p_partkey, CASE WHEN brand IN (SELECT brand FROM top) THEN brand ELSE 'Other' END AS brand FROM t
""")
def bucket_topn(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_brand")).alias("brand"))
    kept = design.top_categories(parts, "brand", 10)
    return parts.select("p_partkey", design.bucket_categories(F.col("brand"), kept).alias("brand"))


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query("one_hot", "M3", """
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_type END AS type FROM part)
SELECT p_partkey, """ + ", ".join(f"coalesce((type = '{t}')::INTEGER, 0) AS \"type_{t}\"" for t in _TYPES[1:]) + " FROM t")
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_type")).alias("type"))
    kinds = design.categories_of(parts, F.col("type"))
    return parts.select("p_partkey", *design.one_hot(F.col("type"), "type", kinds))


@query("align_columns", "M6", """
SELECT p_partkey, p_size, 0 AS absent, p_retailprice FROM part
""")
def align_columns(spark: SparkSession, sf: str) -> DataFrame:
    return design.align_columns(table(spark, sf, "part"), ["p_size", "absent", "p_retailprice"], ["p_partkey"])


_LISTING_SQL = """
SELECT p_partkey AS id, p_retailprice / 4 AS price, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS accommodates,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS room_type, p_brand AS property_type, p_name AS name2
FROM part
"""


def part_listings(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf, "part").select(
        key.alias("id"), (F.col("p_retailprice") / 4).alias("price"),
        F.when(key % 5 != 0, F.col("p_size")).alias("accommodates"),
        F.when(key % 11 != 0, F.col("p_type")).alias("room_type"),
        F.col("p_brand").alias("property_type"), F.col("p_name").alias("name2"),
    )


@query("design_matrix", "M1 M4 M5 N8", f"""
WITH l AS ({_LISTING_SQL}),
top AS (SELECT property_type AS b, row_number() OVER (ORDER BY count(*) DESC, property_type) AS k FROM l GROUP BY 1 QUALIFY k <= 10),
first AS (SELECT least(min(b), 'Other') AS f FROM top)
SELECT id, round(ln(price), 9) AS label,
       coalesce(accommodates::DOUBLE, (SELECT quantile_cont(accommodates::DOUBLE, 0.5) FROM l)) AS accommodates,
       """ + ", ".join(f"coalesce((room_type = '{t}')::INTEGER, 0) AS \"room_type_{t}\"" for t in _TYPES[1:]) + """,
       (CASE WHEN property_type NOT IN (SELECT b FROM top) THEN 'Other' ELSE property_type END <> (SELECT f FROM first))::INTEGER AS property_type_set
FROM l
""")
def design_matrix(spark: SparkSession, sf: str) -> DataFrame:
    listings = part_listings(spark, sf)
    fitted = design.DesignMatrix.fit(listings)
    wide = fitted.transform(listings)
    kinds = [c for c in wide.columns if c.startswith("property_type_")]
    total = sum((F.col(f"`{c}`") for c in kinds[1:]), F.col(f"`{kinds[0]}`"))
    rooms = [c for c in wide.columns if c.startswith("room_type_")]
    return wide.select(
        "id", F.round("label", 9).alias("label"), "accommodates", *[f"`{c}`" for c in rooms], total.alias("property_type_set")
    )


@query("design_defaults", "M7", """
SELECT round(quantile_cont(l_quantity, 0.5), 6) AS l_quantity, round(quantile_cont(l_discount, 0.5), 6) AS l_discount,
       round(quantile_cont(l_tax, 0.5), 6) AS l_tax,
       quantile_cont((l_returnflag = 'N')::INTEGER::DOUBLE, 0.5) AS room_type_N,
       quantile_cont((l_returnflag = 'R')::INTEGER::DOUBLE, 0.5) AS room_type_R
FROM lineitem
""")
def design_defaults(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("price"), "l_quantity", "l_discount", "l_tax",
        F.col("l_returnflag").alias("room_type"),
    )
    fitted = design.DesignMatrix.fit(lines)
    middle = fitted.defaults(lines)
    names = ["l_quantity", "l_discount", "l_tax", "room_type_N", "room_type_R"]
    return spark.createDataFrame(
        [tuple(round(middle[c], 6) for c in names)], ", ".join(f"{c} double" for c in names)
    )


@query("standardise", "M9", """
WITH s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS d, avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) AS d2 FROM lineitem)
SELECT l_returnflag, l_linestatus, round(avg((l_quantity - m) / d), 6) AS quantity, round(max((l_extendedprice - m2) / d2), 6) AS price
FROM lineitem, s GROUP BY l_returnflag, l_linestatus
""")
def standardise(spark: SparkSession, sf: str) -> DataFrame:
    scaled = design.standardise(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    out = scaled.groupBy("l_returnflag", "l_linestatus").agg(
        F.avg("l_quantity").alias("quantity"), F.max("l_extendedprice").alias("price")
    )
    return rounded(out, "quantity", "price")


@query("scenario_rows", "M8", """
WITH areas AS (SELECT c_nationkey, quantile_cont(c_acctbal, 0.5) AS balance FROM customer GROUP BY 1),
d AS (SELECT quantile_cont(c_acctbal, 0.5) AS balance FROM customer)
SELECT s_suppkey, (s_nationkey % 4)::DOUBLE AS bedrooms, round(coalesce(areas.balance, d.balance), 6) AS balance,
       CASE WHEN s_suppkey % 3 = 0 THEN 2.5 ELSE s_acctbal END AS score,
       (s_suppkey % 2 = 1)::INTEGER AS "room_type_Private"
FROM supplier CROSS JOIN d LEFT JOIN areas ON c_nationkey = s_nationkey
""")
def scenario_rows(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("area"), F.col("c_acctbal").alias("balance"))
    areas = design.area_medians(customers, "area", ["balance"])
    defaults = {"bedrooms": 1.0, "score": 2.5, **design.column_medians(customers, ["balance"])}
    scenarios = table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("area"), (F.col("s_nationkey") % 4).alias("bedrooms"),
        F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal")).alias("score"),
        F.when(F.col("s_suppkey") % 2 == 1, "Private").otherwise("Entire").alias("room_type"),
    )
    rows = design.scenario_rows(scenarios, defaults, areas, "area", {"room_type": ["Entire", "Private"]})
    return rounded(rows.drop("area", "room_type"), "balance")


@query("split_counts", "M10", """
SELECT o_orderkey, CASE WHEN substr(md5('42|' || o_orderkey::VARCHAR), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS side FROM orders
""")
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", split_side(F.col("o_orderkey")).alias("side"))


@query("fold_counts", "M11", """
WITH h AS (SELECT substr(md5('42|' || o_orderkey::VARCHAR), 1, 8) AS h, ntile(5) OVER (ORDER BY o_orderkey) - 1 AS block FROM orders)
SELECT (CASE WHEN h < '33333334' THEN 0 WHEN h < '66666667' THEN 1 WHEN h < '9999999a' THEN 2 WHEN h < 'cccccccd' THEN 3 ELSE 4 END)::INTEGER AS fold,
       block::INTEGER AS block, count(*) AS n FROM h GROUP BY 1, 2
""")
def fold_counts(spark: SparkSession, sf: str) -> DataFrame:
    keyed = table(spark, sf, "orders").select("o_orderkey", fold_of(F.col("o_orderkey"), 5).alias("fold"))
    blocks = design.contiguous_folds(keyed, "o_orderkey", 5, "block")
    return blocks.groupBy("fold", "block").agg(F.count(F.lit(1)).alias("n"))


def selectable(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as listings, with a twin column, two flat ones and a pinned one."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("price"), "l_quantity",
        (F.col("l_quantity") * 2 + 1).alias("double_quantity"), "l_discount", "l_tax", "l_linenumber",
        (F.col("l_suppkey") / 1000.0).alias("latitude"), "l_returnflag",
    )


@query("selected_columns", "L3 L4", """
SELECT l_orderkey AS id, l_extendedprice AS price, l_quantity, l_linenumber, l_suppkey / 1000.0 AS latitude, l_returnflag FROM lineitem
""")
def selected_columns(spark: SparkSession, sf: str) -> DataFrame:
    lines = selectable(spark, sf)
    return selection.select_features(lines).transform(lines)


@query("feature_selection", "L1 L2", """
SELECT 'double_quantity' AS feature, 'correlated' AS reason, 'l_quantity' AS other, 1.0::DOUBLE AS value
UNION ALL
SELECT * FROM (SELECT 'l_discount', 'low_variance', NULL, round(var_samp(l_discount), 9) FROM lineitem)
UNION ALL
SELECT * FROM (SELECT 'l_tax', 'low_variance', NULL, round(var_samp(l_tax), 9) FROM lineitem)
""")
def feature_selection(spark: SparkSession, sf: str) -> DataFrame:
    lines = selectable(spark, sf)
    return rounded(selection.select_features(lines).report(lines), "value", digits=9)


@query("leakage_flags", "L5 V4", """
WITH t AS (SELECT l_extendedprice AS price, l_quantity, l_extendedprice + 20000 * l_discount AS leak,
             l_extendedprice + 1500 * l_quantity AS hint FROM lineitem
           WHERE substr(md5('42|' || l_orderkey::VARCHAR), 1, 8) >= '33333333'),
r AS (SELECT 'l_quantity' AS "column", abs(corr(l_quantity, price)) AS r FROM t
      UNION ALL SELECT 'leak', abs(corr(leak, price)) FROM t UNION ALL SELECT 'hint', abs(corr(hint, price)) FROM t)
SELECT "column", round(r, 6) AS abs_r, CASE WHEN r >= 0.7 THEN 'risk' WHEN r >= 0.5 THEN 'warning' ELSE 'ok' END AS verdict FROM r
""")
def leakage_flags(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    rows = table(spark, sf, "lineitem").where(split_side(F.col("l_orderkey")) == "train").select(
        price.alias("price"), "l_quantity", (price + 20000 * F.col("l_discount")).alias("leak"),
        (price + 1500 * F.col("l_quantity")).alias("hint"),
    )
    return rounded(selection.leakage_flags(rows, "price"), "abs_r")
