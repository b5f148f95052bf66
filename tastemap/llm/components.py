"""Connected components of an edge table by alternating large-star and small-star steps.

Each round needs a constant number of joins and group-bys, whose group-bys pre-aggregate
and whose joins are plain equi-joins (a hub's rows can be split); rounds grow with the
logarithm of the number of nodes. No component is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm._common import stage_table


def _down(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` with columns ``a, b`` of one type; returns ``node, root``: every node that is
    not the smallest of its component, with the smallest. Loops and repeats do no harm."""
    edges = stage_table(_down(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), name)
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _down(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage_table(_down(small.union(least.select("u", F.col("m").alias("v")))), name)
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
