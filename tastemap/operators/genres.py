"""Genre encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import genre_set
from ..session import materialize
from .numbering import number_rows


def movie_genres(movies: DataFrame) -> DataFrame:
    """Long one-hot form: one row per (movieId, genre) present; narrow, no shuffle."""
    return movies.select("movieId", F.explode(genre_set("genres")).alias("genre"))


def genre_vocabulary(movies: DataFrame) -> DataFrame:
    """Sorted distinct genre tokens."""
    return movie_genres(movies).select("genre").distinct().orderBy("genre")


def distinct_genre_strings(movies: DataFrame) -> DataFrame:
    """The raw genre strings as written."""
    return movies.select("genres").distinct()


def numbered_vocabulary(movies: DataFrame) -> DataFrame:
    """E1 as a dictionary table: ``genre, number``, 0.. in sorted order, of any size."""
    return number_rows(movie_genres(movies).select("genre").distinct(), "genre")


def genre_indices(movies: DataFrame) -> DataFrame:
    """E2, sparse: ``movieId, indices``, the sorted numbers of a movie's genres in the vocabulary
    (an empty array without genres). One row per movie row; nothing is held on the driver."""
    rows = movies.select("movieId", "genres").withColumn("_row", F.monotonically_increasing_id())
    rows = materialize(rows, "genre-rows")
    held = rows.select("_row", F.explode(genre_set("genres")).alias("genre")).join(numbered_vocabulary(movies), "genre") \
        .groupBy("_row").agg(F.sort_array(F.collect_list("number")).alias("indices"))
    return rows.join(held, "_row", "left").select(
        "movieId", F.coalesce("indices", F.array().cast("array<bigint>")).alias("indices"))


def collect_vocabulary(movies: DataFrame) -> list[str]:
    """The vocabulary on the driver, for the wide form, whose columns are part of the plan."""
    return [r["genre"] for r in genre_vocabulary(movies).collect()]


def genre_flags(movies: DataFrame, vocabulary: list[str] | None = None) -> DataFrame:
    """E2 as one array column: ``flags[j] = 1`` when the movie has the vocabulary's genre j;
    repeated tokens give 1, a missing genre string gives all zeros.

    The dense form of ``genre_indices``: as wide as the vocabulary, so for small ones. With a
    ``vocabulary`` of the caller's own it is a projection over the movie rows.
    """
    if vocabulary is not None:
        vocab = F.array(*[F.lit(g) for g in vocabulary]) if vocabulary else F.array().cast("array<string>")
        gs = genre_set("genres")
        return movies.select("movieId", F.transform(vocab, lambda g: F.array_contains(gs, g).cast("int")).alias("flags"))
    size = movie_genres(movies).agg(F.count_distinct("genre")).first()[0]
    flags = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long")), lambda j: F.array_contains("indices", j).cast("int")) \
        if size else F.array().cast("array<int>")
    return genre_indices(movies).select("movieId", flags.alias("flags"))


def genre_onehot_wide(movies: DataFrame, vocabulary: list[str]) -> DataFrame:
    """E2 wide: one 0/1 column per vocabulary entry, next to movieId and title."""
    gs = genre_set("genres")
    return movies.select("movieId", "title",
                         *[F.array_contains(gs, g).cast("int").alias(g) for g in vocabulary])
