"""Rating tables derived from the driver's parquet tables.

The driver ships TPC-H-like tables; the rating model is laid over them as views:
a customer is a user, a part is an item, an order line is an interaction whose
quantity gives a half-star rating, and the event stream carries the tags. Both
Spark and the DuckDB oracles build the same rows from these definitions.

All views are lazy DataFrames. Each reads only the columns it needs, so the
parquet scans prune columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the views.
NO_GENRES = "(no genres listed)"
NO_GENRES_SIZE = 50


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings_from(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per (user, item): the highest half-star rating and latest order date."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    joined = o.join(li, o.o_orderkey == li.l_orderkey)
    return (joined.groupBy(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"))
            .agg(F.max(F.ceil(F.col("l_quantity") / 5) * F.lit(0.5)).alias("rating"),
                 F.max("o_orderdate").alias("ts")))


def event_ratings_from(tags: DataFrame) -> DataFrame:
    """Implicit ratings from the whole event stream: half a star per event of a user with an
    item, five at most. It covers few items, so it leaves unrated ones without any filter."""
    return (tags.groupBy("userId", "movieId")
            .agg(F.least(F.count(F.lit(1)) * F.lit(0.5), F.lit(5.0)).alias("rating"),
                 F.max("ts").alias("ts")))


def movies_from(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("movieId"),
        F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")")).alias("title"),
        F.when(F.col("p_size") == NO_GENRES_SIZE, F.lit(NO_GENRES))
         .otherwise(F.concat(F.regexp_replace(F.col("p_name"), " ", "|"), F.lit("|"), F.col("p_type")))
         .alias("genres"))


def tags_from(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("userId"),
        F.regexp_extract(F.col("props"), "[0-9]+", 0).try_cast("bigint").alias("movieId"),
        F.col("event_type").alias("tag"),
        F.col("ts"))


def links_from(lineitem: DataFrame) -> DataFrame:
    return (lineitem.groupBy(F.col("l_partkey").alias("movieId"))
            .agg(F.min("l_suppkey").cast("string").alias("imdbId"),
                 F.max("l_suppkey").cast("string").alias("tmdbId")))


class Tables:
    """The four logical tables plus the event ratings, built on first use.

    Each source file is opened (file listing and footer read) only when a view
    that needs it is first asked for, so a query pays only for its own inputs.
    """

    NAMES = ("ratings", "event_ratings", "movies", "links", "tags")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def _src(self, name: str) -> DataFrame:
        return _read(self._spark, self._dir, name)

    @cached_property
    def _orders(self) -> DataFrame:
        return self._src("orders")

    @cached_property
    def _lineitem(self) -> DataFrame:
        return self._src("lineitem")

    @cached_property
    def ratings(self) -> DataFrame:
        return ratings_from(self._orders, self._lineitem)

    @cached_property
    def event_ratings(self) -> DataFrame:
        return event_ratings_from(self.tags)

    @cached_property
    def movies(self) -> DataFrame:
        return movies_from(self._src("part"))

    @cached_property
    def links(self) -> DataFrame:
        return links_from(self._lineitem)

    @cached_property
    def tags(self) -> DataFrame:
        return tags_from(self._src("events"))

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.NAMES}


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def register_views(spark: SparkSession, tables: Tables | dict[str, DataFrame]) -> None:
    """S3: every table as a temporary view under its own name."""
    items = tables.as_dict() if isinstance(tables, Tables) else tables
    for name, df in items.items():
        df.createOrReplaceTempView(name)


def item_factors_from(embeddings: DataFrame) -> DataFrame:
    """Learned-factor stand-in: ``id, features`` from the embeddings table."""
    return embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))


def load_item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_factors_from(_read(spark, sf_dir, "embeddings"))
