"""Model store, row numbers, the genre dictionary and scratch tables."""

import os
from urllib.parse import urlparse

from pyspark.sql import functions as F

from tastemap import session
from tastemap.operators import biased_mf as BMF
from tastemap.operators import genres as G
from tastemap.operators import numbering
from tastemap.operators import store as STORE


def model(spark, mu, rank=2):
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    factors = (one([(1, [0.5, 1.5])], "id bigint, features array<double>"),) * 2 if rank else (None, None)
    return BMF.BiasedMF(mu, one([(7, 0.25)], "movieId bigint, b_i double"), one([(1, -0.5)], "userId bigint, b_u double"),
                        *factors, rank, (0.5, 5.0))


def test_newest_complete_version_is_served(spark, tmp_path):
    root = str(tmp_path / "models")
    assert STORE.load_newest(spark, root) is None and STORE.versions(spark, root) == []
    assert STORE.save_version(model(spark, 1.0), root, "a") == 1
    assert STORE.save_version(model(spark, 2.0, rank=0), root, "b") == 2
    # a writer lost before its manifest, and one lost while writing it
    model(spark, 3.0).item_bias.write.parquet(f"{root}/v3/item_bias")
    os.makedirs(f"{root}/v4/manifest/_temporary")
    assert STORE.versions(spark, root) == [(1, True), (2, True), (3, False), (4, False)]
    newest = STORE.load_newest(spark, root)
    assert (newest.mu, newest.rank, newest.user_factors, newest.rating_scale) == (2.0, 0, None, (0.5, 5.0))
    older = STORE.load_newest(spark, root, "a")
    assert older.mu == 1.0 and older.item_factors.first()["features"] == [0.5, 1.5] and older.item_bias.first()["b_i"] == 0.25
    assert STORE.load_newest(spark, root, "unknown") is None
    assert STORE.save_version(model(spark, 5.0), root) == 5 and STORE.load_newest(spark, root).mu == 5.0


def test_fingerprint_follows_the_rows(spark):
    df = spark.createDataFrame([(u, i, 1.0 + u % 3) for u in range(20) for i in range(9)], "userId bigint, movieId bigint, rating double")
    told = STORE.rows_fingerprint(df)
    assert told == STORE.rows_fingerprint(df.repartition(3)) != STORE.rows_fingerprint(df.where("userId > 0"))
    assert told != STORE.rows_fingerprint(df.withColumn("rating", F.when(F.col("movieId") == 3, 5.0).otherwise(F.col("rating"))))


def test_rows_are_numbered_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000 - 100).alias("key")).repartition(7)
    got = numbering.number_rows(df, "key").collect()
    assert sorted((r["key"], r["number"]) for r in got) == [(k - 100, k) for k in range(5000)]
    assert numbering.number_rows(df.limit(0), "key").collect() == []


def test_wide_genre_vocabulary_has_no_cap(spark):
    """More genres than the old cap; every movie keeps its own, as sorted numbers."""
    n = 110_000
    movies = spark.range(n).select(F.col("id").alias("movieId"), F.concat(
        F.lit("g"), F.lpad(F.col("id").cast("string"), 7, "0"), F.lit("|g0000000|g0000000")).alias("genres"))
    movies = movies.unionByName(spark.createDataFrame([(n, None), (n + 1, ""), (n + 1, "g0000005")], "movieId bigint, genres string"))
    got = G.genre_indices(movies)
    assert got.count() == n + 3
    bad = got.where(F.col("movieId") < n).where(F.col("indices") != F.when(F.col("movieId") == 0, F.array(F.lit(0).cast("long")))
                                                 .otherwise(F.array(F.lit(0).cast("long"), F.col("movieId"))))
    assert bad.count() == 0
    assert sorted(r["indices"] for r in got.where(F.col("movieId") >= n).collect()) == [[], [], [5]]


def test_clean_up_leaves_no_scratch_table(spark):
    from tastemap.operators.scoring import topk_scores
    base = urlparse(session.ensure_checkpoint_dir(spark)).path
    session.clean_up(spark)
    before = set(os.listdir(base))
    df = spark.range(20).selectExpr("id", "array(cast(id as double)) AS features")
    topk_scores(df, df, 2).collect()
    numbering.number_rows(df.select("id"), "id").collect()
    assert set(os.listdir(base)) > before
    assert session.clean_up(spark) >= 4 and set(os.listdir(base)) == before
