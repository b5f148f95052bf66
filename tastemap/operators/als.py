"""Matrix factorisation with Spark ML's ALS.

ALS is Spark's own blocked, distributed solver: ratings are hash-partitioned
into user and item blocks, every iteration exchanges factor blocks, and with a
checkpoint folder set the factor lineage is cut every ``checkpoint_interval``
iterations (so a lost executor does not replay the whole fit). Ids must be
32-bit ints; wider ids are numbered densely for the fit (``dense_ids``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dot, one_key
from ..session import discard, materialize, sweep
from .numbering import number_rows
from .popularity import most_rated_left
from .scoring import topk_scores

DEFAULT_SEED = 4711

# Fold / split hash: stable, reproducible by SQL as pmod(31*userId + 17*movieId, n).
HASH_USER_WEIGHT = 31
HASH_ITEM_WEIGHT = 17


# M1 ---------------------------------------------------------------------------------
def hash_bucket(n: int, user: str = "userId", item: str = "movieId"):
    """Deterministic bucket of a (user, item) pair in 0..n-1, the same in SQL."""
    return F.pmod(F.lit(HASH_USER_WEIGHT) * F.col(user).cast("bigint")
                  + F.lit(HASH_ITEM_WEIGHT) * F.col(item).cast("bigint"), F.lit(n))


def split_hash(ratings: DataFrame, n_buckets: int = 5, test_bucket: int = 0):
    """Split by ``hash_bucket``: one bucket in ``n_buckets`` is the test set."""
    b = hash_bucket(n_buckets)
    return ratings.where(b != test_bucket), ratings.where(b == test_bucket)


def split_random(ratings: DataFrame, test_share: float = 0.2, seed: int = DEFAULT_SEED):
    """Seeded random split by row: a row's draw is a hash of its ids and the seed, so the split
    stays the same however the rows are dealt out (``randomSplit`` follows their partitions)."""
    if not 0 <= test_share <= 1:
        raise ValueError(f"test_share must lie in 0..1: {test_share}")
    draw = F.pmod(F.xxhash64(F.col("userId").cast("bigint"), F.col("movieId").cast("bigint"), F.lit(seed)), F.lit(1 << 30))
    test = draw < F.lit(int(test_share * (1 << 30)))
    return ratings.where(~test), ratings.where(test)


# M2 ---------------------------------------------------------------------------------
def make_als(rank: int = 10, max_iter: int = 10, reg_param: float = 0.1, *,
             rating_col: str = "rating", cold_start: str = "drop", seed: int = DEFAULT_SEED,
             nonnegative: bool = False, implicit: bool = False, alpha: float = 1.0,
             blocks: int | None = None, checkpoint_interval: int | None = None) -> ALS:
    als = ALS(userCol="userId", itemCol="movieId", ratingCol=rating_col, rank=rank,
              maxIter=max_iter, regParam=reg_param, coldStartStrategy=cold_start, seed=seed,
              nonnegative=nonnegative, implicitPrefs=implicit, alpha=alpha)
    # ALS's own defaults (10 blocks, 10 iterations between checkpoints): see ``sized``.
    if checkpoint_interval:
        als.setCheckpointInterval(checkpoint_interval)
    if blocks:
        als.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    return als


# A block's ratings take 12 bytes each while it is built, 8 after that.
RATINGS_PER_BLOCK = 32_000_000
# Every half-step sends a factor row to each block of the other side that rates it, so what
# a fit shuffles grows with the blocks until each rating is in a block of its own.
MOST_BLOCKS = 4
# From so many ratings on a fit lives on disk: its blocks are read from there for each half-step, and
# the factors are checkpointed every few iterations, which deletes the shuffle files before.
LARGE_FIT = 8_000_000
LARGE_INTERVAL = 4


def sized(estimator: ALS, spark: SparkSession, n_rows: int) -> ALS:
    """Give the estimator one block per task slot, up to ``MOST_BLOCKS``, and more where the data
    need it, unless it has its own. The session is the data's: worker threads have no active one."""
    if n_rows >= LARGE_FIT:
        if not estimator.isSet(estimator.checkpointInterval):
            estimator.setCheckpointInterval(LARGE_INTERVAL)
        if not estimator.isSet(estimator.intermediateStorageLevel):
            estimator.setIntermediateStorageLevel("DISK_ONLY")
    if not estimator.isSet(estimator.numUserBlocks):
        blocks = max(min(spark.sparkContext.defaultParallelism, MOST_BLOCKS), -(-n_rows // RATINGS_PER_BLOCK))
        estimator.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    return estimator


MAX_ID = (1 << 31) - 1


def dense_ids(ids: DataFrame, column: str) -> DataFrame:
    """``column, dense int``: distinct ids numbered from 0 in ascending order."""
    distinct = ids.select(F.col(column).cast("bigint").alias(column)).distinct()
    out = materialize(number_rows(distinct, column, name="dense"), f"dense-{column}")
    if out.count() > MAX_ID + 1:
        raise ValueError(f"more than {MAX_ID + 1} distinct values of {column}")
    return out.withColumn("dense", F.col("dense").cast("int"))


@dataclass
class FactorModel:
    """An ALS fit with the caller's ids: ``userFactors`` and ``itemFactors`` hold ``id,
    features``; ``als`` is Spark's own model (of dense ids if some id exceeds 32 bits). It refers to
    the fit's blocks and shuffle files, so of a fit of ``LARGE_FIT`` ratings only the factors are kept."""

    userFactors: DataFrame
    itemFactors: DataFrame
    als: ALSModel | None
    rank: int


def id_span(rows: DataFrame) -> tuple:
    """Row count and the least and greatest ids of users and items."""
    return tuple(rows.agg(F.count(F.lit(1)), *(f(c) for c in ("userId", "movieId") for f in (F.min, F.max))).first())


def fit_persisted(estimator: ALS, rows: DataFrame, span: tuple | None = None) -> FactorModel:
    """Fit with the input written once: ALS reads its input more than once (to size and to
    block the ratings), and each read would otherwise recompute the input's lineage. Ids beyond
    32 bits are numbered densely for the fit and come back in the factors. ``span``: the rows'
    ``id_span``, when the caller has it and keeps the rows. What a large fit leaves on the
    executors is deleted when its factors are written."""
    value = estimator.getRatingCol()
    spark = rows.sparkSession
    kept = rows.select(F.col("userId").cast("bigint").alias("userId"), F.col("movieId").cast("bigint").alias("movieId"),
                       value)
    own_copy = span is None
    if own_copy:
        kept = materialize(kept, "als-input")
    try:
        span = span or id_span(kept)
        wide = span[0] and max(abs(x) for x in span[1:]) > MAX_ID
        maps = {c: dense_ids(kept, c) for c in ("userId", "movieId")} if wide else {}
        fit_rows = kept
        for c, m in maps.items():
            fit_rows = fit_rows.join(m, c).drop(c).withColumnRenamed("dense", c)
        fit_rows = fit_rows.select(F.col("userId").cast("int").alias("userId"),
                                   F.col("movieId").cast("int").alias("movieId"), value)
        model = sized(estimator, spark, span[0]).fit(fit_rows)
    finally:
        if own_copy:
            discard(kept)

    def own(factors: DataFrame, column: str) -> DataFrame:
        if column not in maps:
            return factors.select(F.col("id").cast("bigint").alias("id"), "features")
        return factors.join(maps[column], F.col("id") == F.col("dense")).select(F.col(column).alias("id"), "features")

    users, items, rank = own(model.userFactors, "userId"), own(model.itemFactors, "movieId"), model.rank
    if span[0] >= LARGE_FIT:
        users, items, model = materialize(users, "als-users"), materialize(items, "als-items"), None
        sweep(spark)
    return FactorModel(users, items, model, rank)


def fit_als(train: DataFrame, rank: int = 10, max_iter: int = 10, reg_param: float = 0.1,
            **kwargs) -> FactorModel:
    return fit_persisted(make_als(rank, max_iter, reg_param, **kwargs),
                         train.select("userId", "movieId", kwargs.get("rating_col", "rating")))


# M6 / A11 -----------------------------------------------------------------------------
def predict(model: FactorModel, rows: DataFrame) -> DataFrame:
    """``rows`` + ``prediction``; rows of unknown users or items vanish (cold start "drop")."""
    uf = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("_p"))
    itf = model.itemFactors.select(F.col("id").alias("movieId"), F.col("features").alias("_q"))
    out = rows.join(uf, "userId").join(itf, "movieId")
    return out.withColumn("prediction", dot("_p", "_q").cast("float")).drop("_p", "_q")


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> float:
    ev = RegressionEvaluator(metricName="rmse", labelCol=label, predictionCol=prediction)
    return ev.evaluate(predictions)


@dataclass
class RatingFold:
    """What all fits of one fold share, kept until ``release``."""

    rows: DataFrame
    span: tuple
    held_out: DataFrame

    def release(self) -> None:
        self.rows.unpersist()
        self.held_out.unpersist()


def rating_fold(train: DataFrame, held_out: DataFrame) -> RatingFold:
    rows, held_out = (x.select("userId", "movieId", "rating").persist(StorageLevel.MEMORY_AND_DISK)
                      for x in (train, held_out))
    return RatingFold(rows, id_span(rows), held_out)


def rating_fold_rmse(fold: RatingFold, rank: int, max_iter: int, reg_param: float, **kwargs) -> float:
    """RMSE on the held-out rows, as ``fit_als``, ``predict`` and ``rmse`` give it."""
    model = fit_persisted(make_als(rank, max_iter, reg_param, **kwargs), fold.rows, fold.span)
    told = rmse(predict(model, fold.held_out))
    for factors in (model.userFactors, model.itemFactors):
        if hasattr(factors, "scratch_path"):  # of a large fit
            discard(factors)
    return told


def rmse_frame(predictions: DataFrame, label: str = "rating", prediction: str = "prediction",
               digits: int | None = 6) -> DataFrame:
    """RMSE as a one-row DataFrame (``n, rmse``), the same formula SQL states."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    out = predictions.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"))
    return out.withColumn("rmse", F.round("rmse", digits)) if digits is not None else out


# R1 / R2 ------------------------------------------------------------------------------
def _top_items(model: FactorModel, users: DataFrame | None, k: int,
               chunk_rows: int | None = None) -> DataFrame:
    """Top-k items by predicted rating (``p_u . q_i``), ties to the lower item id.

    Same ranking as ``recommendForAllUsers`` / ``recommendForUserSubset``, but
    scored with the bounded-broadcast scorer: those built-ins cross-join factor
    blocks, this plan never forms a cartesian product.
    """
    uf = model.userFactors
    if users is not None:
        uf = uf.join(users.select(F.col("userId").alias("id")), "id", "left_semi")
    top = topk_scores(uf, model.itemFactors, k, mode="dot", chunk_rows=chunk_rows)
    return top.select(F.col("query_id").alias("userId"), "rank", F.col("cand_id").alias("movieId"),
                      F.col("score").alias("predicted_rating"))


def recommend_all(model: FactorModel, k: int = 10, chunk_rows: int | None = None) -> DataFrame:
    """R2: top-k for every user of the model, one row per (user, rank)."""
    return _top_items(model, None, k, chunk_rows)


def recommend_for_users(model: FactorModel, users: DataFrame, k: int, movies: DataFrame,
                        ratings: DataFrame) -> DataFrame:
    """R1 for a batch of users.

    Users the model knows get its top-k (only their factor rows are scored).
    Others get the most-rated list (fallback A), joined as one row of k entries. Columns: ``userId, is_known, rank, movieId, predicted_rating,
    title, genres``.
    """
    req = users.select(F.col("userId").try_cast("bigint").alias("userId")).where(
        F.col("userId").isNotNull()).distinct()
    known_ids = model.userFactors.select(F.col("id").cast("bigint").alias("userId"))
    known = req.join(known_ids, "userId", "left_semi")
    unknown = req.join(known_ids, "userId", "left_anti")

    recs = _top_items(model, known, k)
    recs = recs.join(movies.select(F.col("movieId").cast("bigint").alias("movieId"), "title", "genres"),
                     "movieId", "left")
    recs = recs.select("userId", F.lit(True).alias("is_known"), "rank", "movieId",
                       F.col("predicted_rating").cast("double").alias("predicted_rating"),
                       "title", "genres")

    fallback = most_rated_left(movies, ratings, k).select(F.collect_list(
        F.struct("rank", F.col("movieId").cast("bigint").alias("movieId"), "title", "genres")).alias("list"))
    fallback = fallback.withColumn("_one", one_key("list"))  # one row of k entries
    fb = (unknown.withColumn("_one", one_key("userId")).join(F.broadcast(fallback), "_one")
          .select("userId", F.explode("list").alias("f"))
          .select("userId", F.lit(False).alias("is_known"), F.col("f.rank").alias("rank"), "f.movieId",
                  F.lit(None).cast("double").alias("predicted_rating"), "f.title", "f.genres"))
    return recs.unionByName(fb)


# S9 -----------------------------------------------------------------------------------
def save_model(model: FactorModel, path: str) -> None:
    """The factors as two parquet tables."""
    model.userFactors.write.mode("overwrite").parquet(f"{path}/user_factors")
    model.itemFactors.write.mode("overwrite").parquet(f"{path}/item_factors")


def load_model(spark: SparkSession, path: str) -> FactorModel:
    uf, itf = (spark.read.parquet(f"{path}/{n}") for n in ("user_factors", "item_factors"))
    row = itf.select(F.size("features")).first()
    return FactorModel(uf, itf, None, row[0] if row else 0)
