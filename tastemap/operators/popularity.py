"""Most-rated fallback lists.

Ratings are reduced to one count per item before any join, so the join with the
movie table is items-by-items whatever the number of ratings; the top-k itself is
a ``TakeOrderedAndProject`` (each task keeps k rows, the driver merges them).
Ties are broken by item id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rating_counts(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movieId").agg(F.count("rating").alias("n_ratings"))


def most_rated_left(movies: DataFrame, ratings: DataFrame, k: int = 10) -> DataFrame:
    """Fallback A: every movie row, with its rating count (NULL when unrated, sorted
    last), most rated first; columns ``movieId, title, genres, n_ratings, rank``."""
    joined = movies.select("movieId", "title", "genres").join(rating_counts(ratings), "movieId", "left")
    order = (F.col("n_ratings").desc_nulls_last(), F.col("movieId").asc())
    top = joined.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def most_rated_inner(movies: DataFrame, ratings: DataFrame, k: int = 10) -> DataFrame:
    """Fallback B: rated items only (inner join); columns ``title, genres, n_ratings, rank``."""
    joined = rating_counts(ratings).join(movies.select("movieId", "title", "genres"), "movieId")
    order = (F.col("n_ratings").desc(), F.col("movieId").asc())
    top = joined.orderBy(*order).limit(k)
    return (top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
            .select("title", "genres", "n_ratings", "rank"))
