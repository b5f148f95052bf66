"""A store of fitted models: numbered versions, complete once their manifest is written.

A version is a folder of Parquet tables; the manifest, one JSON line, is written after
them. Readers take the newest version with a manifest, so a version that is being written,
or whose writer was lost, is never seen, and readers of an older version are not disturbed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_exists
from .biased_mf import BiasedMF

_TABLES = ("item_bias", "user_bias", "user_factors", "item_factors")


def versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """Version numbers under ``root`` and whether each is complete, oldest first."""
    if not table_exists(spark, root):
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = sorted(int(s.getPath().getName()[1:]) for s in system.listStatus(place) if s.getPath().getName()[1:].isdigit())
    return [(n, table_exists(spark, f"{root}/v{n}/manifest/_SUCCESS")) for n in numbers]


def save_version(model: BiasedMF, root: str, fingerprint: str = "") -> int:
    """Write ``model`` as a new version; ``fingerprint`` names the rows it was fitted to."""
    spark = model.item_bias.sparkSession
    number = max((n for n, _ in versions(spark, root)), default=0) + 1
    folder = f"{root}/v{number}"
    tables = [t for t in _TABLES if getattr(model, t) is not None]
    for table in tables:
        getattr(model, table).write.mode("errorifexists").parquet(f"{folder}/{table}")
    manifest = {"mu": model.mu, "rank": model.rank, "rating_scale": list(model.rating_scale), "tables": tables, "fingerprint": fingerprint}
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "line string").coalesce(1).write.text(f"{folder}/manifest")
    return number


def load_newest(spark: SparkSession, root: str, fingerprint: str | None = None) -> BiasedMF | None:
    """The newest complete version, if ``fingerprint`` is given the newest of those rows."""
    for number, complete in reversed(versions(spark, root)):
        if not complete:
            continue
        folder = f"{root}/v{number}"
        manifest = json.loads(spark.read.text(f"{folder}/manifest").first()[0])
        if fingerprint is None or manifest["fingerprint"] == fingerprint:
            held = {t: spark.read.parquet(f"{folder}/{t}") if t in manifest["tables"] else None for t in _TABLES}
            return BiasedMF(manifest["mu"], held["item_bias"], held["user_bias"], held["user_factors"], held["item_factors"],
                            manifest["rank"], tuple(manifest["rating_scale"]))
    return None


def rows_fingerprint(ratings: DataFrame) -> str:
    """Count and order-free hash sums of training rows."""
    told = F.xxhash64("userId", "movieId", F.col("rating").cast("double"))
    row = ratings.agg(F.count(F.lit(1)), F.sum(F.shiftright(told, 24)), F.bit_xor(told)).first()
    return ":".join(str(x) for x in row)
