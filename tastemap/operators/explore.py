"""Exploration queries over the rating tables (Q1-Q11).

Scale notes, applied throughout:
* Ratings are the big table; items, titles and users are dimension-sized. Every
  query that joins ratings to movies first reduces ratings to one row per item
  (partial + final hash aggregate, so the shuffle carries per-partition partial
  counts, never raw ratings), then joins the small result. The join input then
  grows with the number of items, not with the number of ratings.
* Counting "distinct over several tables" is one shuffle on the key over a
  union of pre-deduplicated key columns, not one distinct job per table.
* Ordered full results use a global sort (range partitioning, sampled bounds),
  which splits a hot user over several tasks; top-k results use
  ``orderBy().limit()`` (TakeOrderedAndProject).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import genre_set, one_key


def _ranked(df: DataFrame, *order: F.Column, name: str = "rank") -> DataFrame:
    """Number the rows of an already *bounded* result 1..k in ``order``."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


# Q1 ---------------------------------------------------------------------------
def min_ratings_per_key(ratings: DataFrame) -> DataFrame:
    """Smallest number of ratings of any user and of any item (long form)."""
    per_user = (ratings.groupBy("userId").count()
                .agg(F.min("count").alias("value"))
                .select(F.lit("min_ratings_per_user").alias("stat"), "value"))
    per_item = (ratings.groupBy("movieId").count()
                .agg(F.min("count").alias("value"))
                .select(F.lit("min_ratings_per_item").alias("stat"), "value"))
    return per_user.unionByName(per_item)


# Q2 ---------------------------------------------------------------------------
def items_rated_once(ratings: DataFrame) -> DataFrame:
    """Items with exactly one rating, out of all rated items: one aggregation."""
    per_item = ratings.groupBy("movieId").count()
    return per_item.agg(
        F.count(F.when(F.col("count") == 1, True)).alias("items_rated_once"),
        F.count(F.lit(1)).alias("rated_items"))


# Q3 ---------------------------------------------------------------------------
def user_count(ratings: DataFrame, tags: DataFrame) -> DataFrame:
    """Distinct users seen in ratings or tags."""
    ids = (ratings.select("userId").distinct()
           .unionByName(tags.select("userId").distinct()))
    return ids.agg(F.count_distinct("userId").alias("user_count"))


# Q4 / Q5 ----------------------------------------------------------------------
def item_presence(movies: DataFrame, ratings: DataFrame, links: DataFrame,
                  tags: DataFrame) -> DataFrame:
    """One row per item id with the tables it appears in.

    Each source is deduplicated on its own first (map-side partial aggregate),
    then one shuffle on ``movieId`` merges the flags.
    """
    def flags(df: DataFrame, name: str) -> DataFrame:
        d = df.select("movieId").where(F.col("movieId").isNotNull()).distinct()
        return d.select("movieId", *[F.lit(n == name).alias(f"in_{n}")
                                     for n in ("movies", "ratings", "links", "tags")])

    unioned = (flags(movies, "movies").unionByName(flags(ratings, "ratings"))
               .unionByName(flags(links, "links")).unionByName(flags(tags, "tags")))
    return unioned.groupBy("movieId").agg(
        *[F.bool_or(f"in_{n}").alias(f"in_{n}") for n in ("movies", "ratings", "links", "tags")])


def item_count(movies: DataFrame, ratings: DataFrame, links: DataFrame,
               tags: DataFrame) -> DataFrame:
    """Q4: distinct items over movies, ratings, links and tags."""
    return item_presence(movies, ratings, links, tags).agg(F.count(F.lit(1)).alias("item_count"))


def rated_item_counts(movies: DataFrame, ratings: DataFrame, links: DataFrame,
                      tags: DataFrame) -> DataFrame:
    """Q5: items known anywhere, items in movies that have a rating, and the difference."""
    p = item_presence(movies, ratings, links, tags)
    out = p.agg(F.count(F.lit(1)).alias("item_count"),
                F.count(F.when(F.col("in_movies") & F.col("in_ratings"), True))
                .alias("rated_item_count"))
    return out.withColumn("unrated_item_count", F.col("item_count") - F.col("rated_item_count"))


# Q6 ---------------------------------------------------------------------------
def unrated_items(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Movie rows whose id has no rating: anti-join against the distinct, non-NULL
    rated ids. Equal to ``NOT IN`` whenever the rated ids hold no NULL."""
    rated = ratings.select("movieId").where(F.col("movieId").isNotNull()).distinct()
    return movies.join(rated, "movieId", "left_anti")


def unrated_items_not_in(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Movie rows under ``NOT IN`` semantics: those without a rating, but none at all as soon
    as one rated id is NULL; a movie whose own id is NULL only passes an empty rating table.

    A null-aware anti-join would broadcast the rated ids whatever their number. Here they
    are a plain anti-join on distinct ids, and one row of two flags decides the rest.
    """
    flags = ratings.agg(F.count(F.when(F.col("movieId").isNull(), True)).alias("_nulls"),
                        F.count(F.lit(1)).alias("_rows")).withColumn("_one", one_key("_rows"))
    left = unrated_items(movies, ratings).withColumn("_one", one_key("movieId"))
    allowed = (F.col("_nulls") == 0) & (F.col("movieId").isNotNull() | (F.col("_rows") == 0))
    return left.join(F.broadcast(flags), "_one").where(allowed).select(*movies.columns)


# Q7 / Q8 ----------------------------------------------------------------------
def _per_item_stats(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movieId").agg(
        F.count("rating").alias("n_ratings"),
        F.sum(F.col("rating").cast("double")).alias("sum_rating"))


def title_stats(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Per title: number of ratings (0 when none) and the average rating.

    Same result as ``movies LEFT JOIN ratings GROUP BY title``, but ratings are
    reduced to one row per item before the join.
    """
    stats = _per_item_stats(ratings)
    joined = movies.select("movieId", "title").join(stats, "movieId", "left")
    agg = joined.groupBy("title").agg(
        F.coalesce(F.sum("n_ratings"), F.lit(0)).cast("bigint").alias("count"),
        F.sum("sum_rating").alias("_sum"))
    return agg.select(
        "title", "count",
        F.when(F.col("count") > 0, F.col("_sum") / F.col("count")).alias("avg_rating"))


def top_reviewed(movies: DataFrame, ratings: DataFrame, k: int = 100) -> DataFrame:
    """Titles with the most ratings; ties by title."""
    order = (F.col("count").desc(), F.col("title").asc())
    top = title_stats(movies, ratings).select("title", "count").orderBy(*order).limit(k)
    return _ranked(top, *order)


def top_rated(movies: DataFrame, ratings: DataFrame, k: int = 100) -> DataFrame:
    """Per title ``round(avg, 1)`` and count, ordered by count, then rate, then title
    (the order of the original "top rated" list: count first)."""
    s = title_stats(movies, ratings).select(
        "title", F.round(F.col("avg_rating"), 1).alias("rate"), "count")
    order = (F.col("count").desc(), F.col("rate").desc_nulls_last(), F.col("title").asc())
    return _ranked(s.orderBy(*order).limit(k), *order)


# Q9 ---------------------------------------------------------------------------
def genre_counts(movies: DataFrame) -> DataFrame:
    """Movies per genre token (each movie counts a token once); most common first."""
    exploded = movies.select(F.explode(genre_set("genres")).alias("category"))
    return (exploded.groupBy("category").agg(F.count(F.lit(1)).alias("number"))
            .orderBy(F.col("number").desc(), F.col("category")))


# Q10 --------------------------------------------------------------------------
def rating_histogram(ratings: DataFrame) -> DataFrame:
    return (ratings.groupBy(F.col("rating").cast("double").alias("rating"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("rating"))


# Q11 --------------------------------------------------------------------------
def user_history(ratings: DataFrame, movies: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Ratings of the requested users (all users when ``users`` is None) with the
    movie columns and the rating time, ordered by user, rating descending, item.

    ``users`` is a DataFrame with a ``userId`` column; it is applied as a semi-join,
    so a batch of any size works the same way as a single id.
    """
    keep = ["ts"] if "ts" in ratings.columns else []
    r = ratings.select("userId", "movieId", F.col("rating").cast("double").alias("rating"), *keep)
    if users is not None:
        r = r.join(users.select("userId").distinct(), "userId", "left_semi")
    out = r.join(movies.select("movieId", "title", "genres"), "movieId", "left")
    return out.orderBy("userId", F.col("rating").desc(), "movieId")


# SQL text entry -------------------------------------------------------------
def run_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """Run SQL with named parameter markers (``:name``) instead of pasted values."""
    return spark.sql(text, args=params or None)
