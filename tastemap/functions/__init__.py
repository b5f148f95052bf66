"""Column expressions: all built from ``pyspark.sql.functions`` so they stay
inside whole-stage code generation (no Python UDF on any hot path)."""

from .genres import genre_set, genre_tokens
from .scalar import clip, one_key
from .text import join_ranked
from .vectors import dot, unpack

__all__ = ["genre_set", "genre_tokens", "clip", "one_key", "join_ranked",
           "dot", "unpack"]
