"""Input checks and cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import REQUIRED


class EmptyTableError(ValueError):
    """Raised when a table the jobs need has no rows."""


def table_report(tables: dict[str, DataFrame], required: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per table: ``table_name, n_rows, n_rejected``.

    ``n_rejected`` counts rows with a NULL in a required column (a missing or
    malformed value after ``try_cast``). Each table is one scan with a single
    global aggregate; the report itself has one row per table.
    """
    required = required or REQUIRED
    parts = []
    for name, df in tables.items():
        cols = [c for c in required.get(name, []) if c in df.columns]
        bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]) if cols else F.lit(False)
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"),
                            F.count(F.when(bad, True)).alias("n_rejected"))
                     .select(F.lit(name).alias("table_name"), "n_rows", "n_rejected"))
    return reduce(DataFrame.unionByName, parts)


def validate(tables: dict[str, DataFrame], required: dict[str, list[str]] | None = None) -> DataFrame:
    """Build the report, fail naming every empty table, return the report.

    The report is one row per table, so collecting it is bounded.
    """
    report = table_report(tables, required)
    empty = [r["table_name"] for r in report.where(F.col("n_rows") == 0).select("table_name").collect()]
    if empty:
        raise EmptyTableError(f"empty input table(s): {', '.join(sorted(empty))}")
    return report


def clean_ratings(ratings: DataFrame) -> DataFrame:
    """P1-P3 for model input: ``userId bigint, movieId bigint, rating float``.

    Ids keep their full range (``operators.als`` numbers them densely where Spark's ALS
    needs 32 bits); only rows with a missing or malformed value are dropped, and
    ``rejected_ratings`` counts them. The timestamp is dropped.
    """
    return _typed(ratings).na.drop("any")


def _typed(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        F.col("userId").try_cast("bigint").alias("userId"),
        F.col("movieId").try_cast("bigint").alias("movieId"),
        F.col("rating").try_cast("float").alias("rating"))


def rejected_ratings(ratings: DataFrame) -> DataFrame:
    """One row: ``n_rows, n_kept, n_rejected`` of ``clean_ratings``."""
    bad = F.col("userId").isNull() | F.col("movieId").isNull() | F.col("rating").isNull()
    out = _typed(ratings).agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(bad, True)).alias("n_rejected"))
    return out.select("n_rows", (F.col("n_rows") - F.col("n_rejected")).alias("n_kept"), "n_rejected")


def preview(df: DataFrame, key: str | list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by key (a deterministic ``show``)."""
    keys = [key] if isinstance(key, str) else key
    return df.orderBy(*keys).limit(n)


def describe_numeric(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Count, mean, sample stddev, min, max per column, long form.

    One pass over ``df``: a single aggregate computes every statistic of every
    column; ``stack`` then turns the one wide row into one row per column.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack_args = ", ".join(
        f"'{c}', `{c}__n`, `{c}__mean`, `{c}__std`, `{c}__min`, `{c}__max`" for c in cols)
    long = wide.selectExpr(
        f"stack({len(cols)}, {stack_args}) AS (column_name, n, mean, stddev, min, max)")
    return long.select("column_name", "n",
                       *[F.round(F.col(c), digits).alias(c) for c in ("mean", "stddev", "min", "max")])


def describe_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    """S7 for string columns: count, smallest and largest value per column, long form."""
    wide = df.agg(*[a for c in cols for a in (
        F.count(c).alias(f"{c}__n"), F.min(F.col(c).cast("string")).alias(f"{c}__min"),
        F.max(F.col(c).cast("string")).alias(f"{c}__max"))])
    args = ", ".join(f"'{c}', `{c}__n`, `{c}__min`, `{c}__max`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {args}) AS (column_name, n, min, max)")
