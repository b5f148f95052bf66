"""Ordered string aggregation (F8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TITLE_SEPARATOR = " | "


def join_ranked(rank: str, text: str, sep: str = TITLE_SEPARATOR) -> Column:
    """Aggregate: the ``text`` values of a group joined by ``sep`` in ``rank`` order.

    Only used on groups bounded by a top-n cut, so the collected list is small.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(text).alias("t"))))
    return F.array_join(F.transform(ordered, lambda x: x["t"]), sep)
