"""Tables on disk: delimited text in and out, Parquet, lookups and polygon names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hearthrate.functions.parsing import day
from hearthrate.session import spread

CALENDAR_SCHEMA = "listing_id bigint, date string, available string, price string, adjusted_price string, " \
    "minimum_nights int, maximum_nights int"
REVIEWS_SCHEMA = "listing_id bigint, id bigint, date string, reviewer_id bigint, reviewer_name string, comments string"
NEIGHBOURHOOD_SCHEMA = "neighbourhood_group string, neighbourhood string"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    columns: Sequence[str] | None = None,
    dates: Sequence[str] = (),
    multiline: bool = True,
) -> DataFrame:
    """CSV, plain or gzipped. ``multiline`` allows line breaks inside quotes, which
    makes every file one split; a plain file without them is read in many. Without a schema the file is read once to infer it.

    Columns are matched by header name, so a schema may list them in any order
    only if it lists all; pruning happens in ``columns``. A gzip file is one
    split: land it as Parquet once with ``land``.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if columns is not None:
        df = df.select(*columns)
    return df.withColumns({c: day(F.col(c).cast("string")) for c in dates}) if dates else df


def land(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write as Parquet, spreading unsplittable input over the cluster first."""
    writer = spread(df).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_delimited(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(
        spark, path, CALENDAR_SCHEMA, ["listing_id", "date", "available", "minimum_nights"], ["date"], multiline=False
    )


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    df = read_delimited(spark, path, REVIEWS_SCHEMA, ["listing_id", "id", "date", "comments"], ["date"])
    return df.withColumn("comments", F.coalesce("comments", F.lit("")))


def read_dimension(
    spark: SparkSession, path: str, rename: Mapping[str, str] | None = None, schema: str = NEIGHBOURHOOD_SCHEMA
) -> DataFrame:
    df = read_delimited(spark, path, schema, multiline=False)
    for old, new in (rename or {"neighbourhood": "neighbourhood_cleansed"}).items():
        df = df.withColumnRenamed(old, new)
    return df


def read_polygon_names(spark: SparkSession, path: str, name: str = "neighbourhood") -> DataFrame:
    """Names in a GeoJSON feature collection; an absent collection gives no rows."""
    schema = T.StructType([T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    ])))])
    collection = spark.read.schema(schema).option("multiLine", True).json(path)
    return collection.select(F.explode("features").alias("f")).select(F.col("f.properties")[name].alias(name))


def write_polygons(df: DataFrame, name: str, path: str) -> None:
    """A feature collection of named areas. The list of areas is a dimension, so it fits one document."""
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col(name).alias("neighbourhood")).alias("properties"))
    document = df.agg(F.sort_array(F.collect_list(feature)).alias("features")).select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")
    )
    document.write.mode("overwrite").text(path)


def polygon_values(polygons: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Every polygon with the value of its area, if it has one."""
    return polygons.join(values, name, "left")
