"""CSV sources.

The files have one header row, UTF-8 text, and fields holding commas wrapped in
double quotes with doubled quotes inside. Spark only splits those correctly with
``escape='"'``. The typed reader never infers a schema (no extra pass over the
data): it reads strings and converts them with ``try_cast`` so that a malformed
value becomes NULL instead of failing the whole job; the validation report
counts those rows.

``read_csv_checked`` keeps what it rejects: rows come back typed, and every record that is
not a row comes back as text with its file and the reason. It reads line breaks within
quotes, for which Spark gives each file to one task; large tables are many files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import REQUIRED, SCHEMAS


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, header row taken as column names."""
    return (spark.read.option("header", True).option("escape", '"')
            .option("multiLine", False).csv(path))


def read_csv_typed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Columns converted to the dictionary's types; bad values become NULL."""
    schema = SCHEMAS[table]
    raw = read_csv_raw(spark, path)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_tables_csv(spark: SparkSession, folder: str, typed: bool = True) -> dict[str, DataFrame]:
    """``ratings.csv``, ``movies.csv``, ``links.csv``, ``tags.csv`` under ``folder``."""
    out = {}
    for name in SCHEMAS:
        path = os.path.join(folder, f"{name}.csv")
        out[name] = read_csv_typed(spark, path, name) if typed else read_csv_raw(spark, path)
    return out


_DIALECT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV that the readers here give back by value: quotes doubled, white space kept."""
    df.write.options(**_DIALECT).option("header", header).csv(path)


def read_csv_checked(spark: SparkSession, path: str, table: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of one table.

    ``rows`` has the table's types. ``rejects`` is ``file, line, reason``: a record with another
    number of fields (``fields``), a required value that is absent (``<column>: missing``) or any
    value that is not of its type (``<column>: not a <type>``), the first of them in column order.
    Records with a wrong value are written anew as CSV, others are the file's own text. Each
    record is in exactly one of the two; an empty file gives two empty frames.
    """
    schema = SCHEMAS[table]
    strings = ", ".join(f"{f.name} string" for f in schema.fields)
    read = (spark.read.schema(f"{strings}, _record string").options(**_DIALECT).option("header", header)
            .option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record").csv(path))
    reasons = [F.when(F.col("_record").isNotNull(), F.lit("fields"))]
    for f in schema.fields:
        if f.name in REQUIRED[table]:
            reasons.append(F.when(F.col(f.name).isNull(), F.lit(f"{f.name}: missing")))
        reasons.append(F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
                              F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
    told = read.withColumns({"_reason": F.coalesce(*reasons), "_file": F.col("_metadata.file_path")})
    rows = told.where(F.col("_reason").isNull()).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    again = F.to_csv(F.struct(*[f.name for f in schema.fields]), {"escape": '"'})
    rejects = told.where(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("file"), F.coalesce("_record", again).alias("line"), F.col("_reason").alias("reason"))
    return rows, rejects
