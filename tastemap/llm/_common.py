"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.session import record_scratch, scratch_path

#: ASCII white space that separates words (regular-expression class body, Java/RE2/Python).
SPACE = r"\x20\x09-\x0D"


def stage_table(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared scratch folder and read it back: the
    lineage is cut, and a lost executor costs only its own tasks."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    record_scratch(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
    if path is not None:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id long, text binary``: the two columns a Python operator reads, null text as empty."""
    return df.select(F.col(id_col).cast("long").alias("id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows of the named columns, a bounded slice at a time (long texts stay few)."""
    for at in range(0, batch.num_rows, 256):
        part = batch.slice(at, 256)
        yield from zip(*(part.column(part.schema.get_field_index(n)).to_pylist() for n in names))


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII string expression (it has no such function)."""
    return (f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), "
            "lambda c: ascii(c)::BIGINT)), lambda v, b: list_reduce(list_prepend(xor(v, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
            "lambda w, z: CASE WHEN w % 2 = 1 THEN xor(w >> 1, 3988292384::BIGINT) ELSE w >> 1 END)))")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit moves about half of the output bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
