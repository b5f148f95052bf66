"""Schemas of the four input tables, as the data dictionary states them."""

from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("userId", T.LongType(), False),
    T.StructField("movieId", T.LongType(), False),
    T.StructField("rating", T.FloatType(), False),
    T.StructField("timestamp", T.LongType(), False),
])

MOVIES = T.StructType([
    T.StructField("movieId", T.LongType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("genres", T.StringType(), False),
])

LINKS = T.StructType([
    T.StructField("movieId", T.LongType(), False),
    T.StructField("imdbId", T.StringType(), False),
    T.StructField("tmdbId", T.StringType(), True),
])

TAGS = T.StructType([
    T.StructField("userId", T.LongType(), False),
    T.StructField("movieId", T.LongType(), False),
    T.StructField("tag", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), False),
])

SCHEMAS = {"ratings": RATINGS, "movies": MOVIES, "links": LINKS, "tags": TAGS}

# Columns a row cannot do without; a NULL here (missing or malformed) makes the
# row a reject in the validation report.
REQUIRED = {
    "ratings": ["userId", "movieId", "rating"],
    "movies": ["movieId", "title"],
    "links": ["movieId"],
    "tags": ["userId", "movieId"],
}
