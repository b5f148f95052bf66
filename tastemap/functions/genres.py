"""Pipe-separated genre strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR_PATTERN = r"\|"


def genre_tokens(genres: Column | str) -> Column:
    """Tokens in written order, empty tokens removed; NULL input gives an empty array."""
    col = F.col(genres) if isinstance(genres, str) else genres
    return F.coalesce(F.array_remove(F.split(col, SEPARATOR_PATTERN), ""),
                      F.array().cast("array<string>"))


def genre_set(genres: Column | str) -> Column:
    """The genre *set*: distinct tokens, sorted. A repeated token counts once, as in a
    0/1 indicator encoding; ``(no genres listed)`` is a token of its own."""
    return F.array_sort(F.array_distinct(genre_tokens(genres)))
