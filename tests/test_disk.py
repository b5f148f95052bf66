"""What jobs leave on the executors' disks: shuffle files go when the table that needed them is written."""

import time

import pytest
from pyspark.sql import functions as F

from tastemap.operators import als as ALSOPS
from tastemap.operators import biased_mf as BMF
from tastemap.plans import catalog
from tastemap.session import materialize, shuffles_deleted

CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.endswith(".data")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    rows = spark.range(20_000).groupBy((F.col("id") * 7919 % 5003).alias("k")).count().repartition(3, "k")
    before = shuffle_files(spark)
    table = materialize(rows, "no-shuffle-files")
    assert not shuffle_files(spark) - before
    assert table.count() == 5003 and spark.conf.get(CLEANED) == "false"
    with shuffles_deleted(spark), shuffles_deleted(spark):
        assert spark.conf.get(CLEANED) == "true"
    assert spark.conf.get(CLEANED) == "false"


@pytest.fixture()
def ratings(spark):
    return spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(40) for i in range(25) if (u + i) % 3],
                                 "userId bigint, movieId bigint, rating double")


def test_a_large_fit_lives_on_disk(spark, ratings, monkeypatch):
    small = ALSOPS.fit_als(ratings, 3, 6, 0.1)
    monkeypatch.setattr(ALSOPS, "LARGE_FIT", 100)
    estimator = ALSOPS.sized(ALSOPS.make_als(), spark, 100)
    assert estimator.getCheckpointInterval() == ALSOPS.LARGE_INTERVAL < 10
    assert estimator.getIntermediateStorageLevel() == "DISK_ONLY"
    assert ALSOPS.sized(ALSOPS.make_als(checkpoint_interval=7), spark, 100).getCheckpointInterval() == 7
    before = shuffle_files(spark)
    large = ALSOPS.fit_als(ratings, 3, 6, 0.1)
    assert large.als is None and small.als is not None
    assert sorted(map(tuple, large.itemFactors.collect())) == sorted(map(tuple, small.itemFactors.collect()))
    for _ in range(50):  # Spark deletes them in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_large_fits_of_a_grid_run_as_many_as_fill_the_slots(spark):
    slots = spark.sparkContext.defaultParallelism
    assert catalog._fits_at_once(spark, 1000) >= 4
    assert catalog._fits_at_once(spark, ALSOPS.LARGE_FIT) == max(1, slots // ALSOPS.MOST_BLOCKS)


def test_a_biased_fit_keeps_nothing_in_memory(spark, ratings):
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before, most = held(), []
    plain = BMF.fit_persisted
    try:
        BMF.fit_persisted = lambda *a, **k: (most.append(held()), plain(*a, **k))[1]
        BMF.fit_biased_mf(ratings, 2, 2, 0.1)
    finally:
        BMF.fit_persisted = plain
    assert max(most) <= before
