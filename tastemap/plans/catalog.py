"""Named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each entry reads the driver tables under ``sf_dir`` through ``sources.views`` and
runs one operator of the library over the whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import join_ranked, unpack
from ..operators import als as ALSOPS
from ..operators import als_normal as ALSN
from ..operators import biased_mf as BMF
from ..operators import explore as X
from ..operators import genres as G
from ..operators import popularity as P
from ..operators import quality as QC
from ..operators import serving as SRV
from ..operators import sgd as SGD
from ..operators import similarity as SIM
from ..operators import store as STORE
from ..operators import tuning as TUNE
from ..session import materialize, record_scratch, scratch_path
from ..sources.csv import read_csv_checked, write_csv
from ..sources.views import load_item_factors, load_tables, register_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# Exploration -------------------------------------------------------------------
@query("min_ratings_per_key")
def _q_min(spark, d):
    return X.min_ratings_per_key(load_tables(spark, d).ratings)


@query("items_rated_once")
def _q_once(spark, d):
    return X.items_rated_once(load_tables(spark, d).ratings)


@query("user_count")
def _q_users(spark, d):
    t = load_tables(spark, d)
    return X.user_count(t.ratings, t.tags)


@query("item_count")
def _q_items(spark, d):
    t = load_tables(spark, d)
    return X.item_count(t.movies, t.ratings, t.links, t.tags)


@query("rated_item_counts")
def _q_rated(spark, d):
    t = load_tables(spark, d)
    return X.rated_item_counts(t.movies, t.event_ratings, t.links, t.tags)


@query("unrated_items")
def _q_unrated(spark, d):
    t = load_tables(spark, d)
    return X.unrated_items(t.movies, t.event_ratings)


@query("unrated_items_not_in")
def _q_unrated_not_in(spark, d):
    t = load_tables(spark, d)
    return X.unrated_items_not_in(t.movies, t.event_ratings)


@query("sql_title_counts")
def _q_sql(spark, d):
    register_views(spark, load_tables(spark, d))
    return X.run_sql(spark, "SELECT m.title, count(*) AS n_high FROM ratings AS r JOIN movies AS m "
                            "USING (movieId) WHERE r.rating >= :low GROUP BY m.title", low=4.5)


@query("top_reviewed")
def _q_top_reviewed(spark, d):
    t = load_tables(spark, d)
    return X.top_reviewed(t.movies, t.ratings, 100)


@query("top_rated")
def _q_top_rated(spark, d):
    t = load_tables(spark, d)
    return X.top_rated(t.movies, t.ratings, 100)


@query("genre_counts")
def _q_genres(spark, d):
    return X.genre_counts(load_tables(spark, d).movies)


@query("rating_histogram")
def _q_hist(spark, d):
    return X.rating_histogram(load_tables(spark, d).ratings)


@query("user_history")
def _q_history(spark, d):
    t = load_tables(spark, d)
    return X.user_history(t.ratings, t.movies)


# Quality -------------------------------------------------------------------------

VIEW_REQUIRED = {"ratings": ["userId", "movieId", "rating"], "movies": ["movieId", "title"],
                 "links": ["movieId"], "tags": ["userId", "movieId"]}
EMBEDDING_RANK = 64


@query("table_report")
def _q_report(spark, d):
    t = load_tables(spark, d)
    return QC.table_report({"ratings": t.ratings, "movies": t.movies, "links": t.links,
                            "tags": t.tags}, VIEW_REQUIRED)


@query("preview_movies")
def _q_preview(spark, d):
    return QC.preview(load_tables(spark, d).movies, "movieId", 5)


@query("rating_summary")
def _q_summary(spark, d):
    return QC.describe_numeric(load_tables(spark, d).ratings, ["userId", "movieId", "rating"])


# Genres --------------------------------------------------------------------------
@query("genre_vocabulary")
def _q_vocab(spark, d):
    return G.genre_vocabulary(load_tables(spark, d).movies)


@query("movie_genres")
def _q_movie_genres(spark, d):
    return G.movie_genres(load_tables(spark, d).movies)


@query("distinct_genre_strings")
def _q_distinct_genres(spark, d):
    return G.distinct_genre_strings(load_tables(spark, d).movies)


@query("genre_flags")
def _q_flags(spark, d):
    return G.genre_flags(load_tables(spark, d).movies)


@query("genre_indices")
def _q_indices(spark, d):
    return G.genre_indices(load_tables(spark, d).movies)


# Popularity ----------------------------------------------------------------------
@query("most_rated_left")
def _q_fallback_a(spark, d):
    t = load_tables(spark, d)
    return P.most_rated_left(t.movies, t.ratings, 10)


@query("most_rated_inner")
def _q_fallback_b(spark, d):
    t = load_tables(spark, d)
    return P.most_rated_inner(t.movies, t.ratings, 10)


# Vectors and similarity ------------------------------------------------------------
@query("factor_columns")
def _q_unpack(spark, d):
    f = load_item_factors(spark, d)
    return f.select("id", *unpack("features", EMBEDDING_RANK))


@query("similar_by_factors")
def _q_sim_factors(spark, d):
    return SIM.similar_by_factors(load_item_factors(spark, d), 10,
                                  movies=load_tables(spark, d).movies)


@query("similar_by_genres")
def _q_sim_genres(spark, d):
    return SIM.similar_by_genres(load_tables(spark, d).movies, 10, order="nearest")


@query("similar_by_genres_farthest")
def _q_sim_genres_far(spark, d):
    return SIM.similar_by_genres(load_tables(spark, d).movies, 10, order="farthest")


# Models ------------------------------------------------------------------------------

ALS_PARAMS = {"rank": 10, "max_iter": 10, "reg_param": 0.1}
BMF_PARAMS = {"rank": 10, "max_iter": 10, "reg_param": 0.1}
TOP_N = 10


def _train_test(spark, d):
    t = load_tables(spark, d)
    clean = materialize(QC.clean_ratings(t.ratings), "clean-ratings")  # both parts read the same rows
    train, test = ALSOPS.split_hash(clean, 5, 0)
    return t, train, test


def _requests(t):
    """Request batch derived from the data: every user seen in the tag stream."""
    return t.tags.select(F.col("userId")).where(F.col("userId").isNotNull()).distinct()


@query("hash_split_counts")
def _q_split(spark, d):
    clean = QC.clean_ratings(load_tables(spark, d).ratings)
    return (clean.groupBy(ALSOPS.hash_bucket(5).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@query("als_rmse")
def _q_als_rmse(spark, d):
    _, train, test = _train_test(spark, d)
    model = ALSOPS.fit_als(train, **ALS_PARAMS)
    return ALSOPS.rmse_frame(ALSOPS.predict(model, test))


@query("als_item_equations")
def _q_als_equations(spark, d):
    """What the last half-step leaves of each item's normal equations: nothing."""
    _, train, _ = _train_test(spark, d)
    fit = ALSN.fit_in_blocks(train, **ALS_PARAMS)
    try:
        out = materialize(fit.item_residuals(), "item-residuals")
    finally:
        fit.release()
    return out.withColumn("residual", F.round("residual", 6))


@query("als_predictions")
def _q_als_pred(spark, d):
    _, train, test = _train_test(spark, d)
    model = ALSOPS.fit_als(train, **ALS_PARAMS)
    return ALSOPS.predict(model, test).select("userId", "movieId", "rating", "prediction")


@query("als_recommend_all")
def _q_als_all(spark, d):
    _, train, _ = _train_test(spark, d)
    return ALSOPS.recommend_all(ALSOPS.fit_als(train, **ALS_PARAMS), TOP_N)


@query("als_recommend_users")
def _q_als_users(spark, d):
    t, train, _ = _train_test(spark, d)
    model = ALSOPS.fit_als(train, **ALS_PARAMS)
    return ALSOPS.recommend_for_users(model, _requests(t), TOP_N, t.movies, t.ratings)


@query("als_similar_items")
def _q_als_similar(spark, d):
    t, train, _ = _train_test(spark, d)
    model = ALSOPS.fit_als(train, **ALS_PARAMS)
    return SIM.similar_by_factors(model.itemFactors, TOP_N, movies=t.movies)


@query("bias_baseline_rmse")
def _q_bias_rmse(spark, d):
    _, train, test = _train_test(spark, d)
    mu, bi, bu = BMF.bias_baseline(train)
    pred = BMF.baseline_predict(mu, bi, bu, test)
    return ALSOPS.rmse_frame(pred, prediction="estimate")


@query("item_biases")
def _q_item_bias(spark, d):
    _, train, _ = _train_test(spark, d)
    _, bi, _ = BMF.bias_baseline(train)
    return bi.select("movieId", F.round("b_i", 6).alias("b_i"))


@query("user_biases")
def _q_user_bias(spark, d):
    _, train, _ = _train_test(spark, d)
    _, _, bu = BMF.bias_baseline(train)
    return bu.select("userId", F.round("b_u", 6).alias("b_u"))


@query("biased_mf_rmse")
def _q_bmf_rmse(spark, d):
    _, train, test = _train_test(spark, d)
    model = BMF.fit_biased_mf(train, **BMF_PARAMS)
    return ALSOPS.rmse_frame(BMF.predict_biased(model, test), prediction="estimate")


@query("biased_mf_predictions")
def _q_bmf_pred(spark, d):
    _, train, test = _train_test(spark, d)
    model = BMF.fit_biased_mf(train, **BMF_PARAMS)
    return BMF.predict_biased(model, test).select("userId", "movieId", "rating", "estimate")


@query("biased_mf_recommend")
def _q_bmf_rec(spark, d):
    t, train, _ = _train_test(spark, d)
    model = BMF.fit_biased_mf(train, **BMF_PARAMS)
    return BMF.recommend_biased(model, _requests(t), t.movies, TOP_N)


def _served_model(spark, train):
    """The newest stored model of these training rows; the first run fits and stores it."""
    root, told = scratch_path(spark, "served-models"), STORE.rows_fingerprint(train)
    model = STORE.load_newest(spark, root, told)
    if model is None:
        record_scratch(spark, root)
        STORE.save_version(BMF.fit_biased_mf(train, **BMF_PARAMS), root, told)
        model = STORE.load_newest(spark, root, told)
    return model


@query("serve_requests")
def _q_serve(spark, d):
    t, train, _ = _train_test(spark, d)
    req = _requests(t).withColumn("n", F.lit(TOP_N))
    return SRV.serve(req, _served_model(spark, train), t.movies, t.ratings)


# Bias-only forms (rank 0), which SQL can state, over requests from given tables.
def _bias_model(train):
    return BMF.fit_biased_mf(train, rank=0)


@query("bias_recommend")
def _q_bias_rec(spark, d):
    t, train, _ = _train_test(spark, d)
    out = BMF.recommend_biased(_bias_model(train), _requests(t), t.movies, TOP_N)
    return out.withColumn("estimate_rating", F.round("estimate_rating", 6))


def _part_requests(spark, d):
    """Part keys as user ids (some known, some not), twice with other counts: repeats,
    several n per user, and n = 0."""
    part = spark.read.parquet(f"{d}/part.parquet")
    n = F.pmod(F.col("p_size"), F.lit(7)).cast("int").alias("n")
    half = F.floor(F.col("p_partkey") / 2).cast("bigint").alias("userId")
    return part.select(F.col("p_partkey").alias("userId"), n).unionByName(part.select(half, n))


@query("serve_bias_requests")
def _q_serve_bias(spark, d):
    t, train, _ = _train_test(spark, d)
    return SRV.serve(_part_requests(spark, d), _bias_model(train), t.movies, t.ratings)


@query("bias_tuning_report")
def _q_bias_tuning(spark, d):
    _, train, _ = _train_test(spark, d)
    points = TUNE.grid(lambda_item=[5.0, 10.0], lambda_user=[5.0, 15.0])

    def prepare(fit_rows, eval_rows):
        return fit_rows, eval_rows, BMF.item_sums(fit_rows)

    def fit_eval(shared, p):
        fit_rows, eval_rows, items = shared
        mu, bi, bu = BMF.bias_baseline(fit_rows, p["lambda_item"], p["lambda_user"], items=items)
        return ALSOPS.rmse(BMF.baseline_predict(mu, bi, bu, eval_rows), prediction="estimate")
    out = TUNE.cross_validate(train, points, fit_eval, n_folds=3, fold=ALSOPS.hash_bucket(3).cast("int"), prepare=prepare)
    return out.select("grid_id", "fold", F.round("rmse", 6).alias("rmse"),
                      F.round("avg_rmse", 6).alias("avg_rmse"), "is_best")


@query("rejected_ratings")
def _q_rejected(spark, d):
    return QC.rejected_ratings(load_tables(spark, d).ratings)


@query("movie_text_summary")
def _q_text_summary(spark, d):
    return QC.describe_strings(load_tables(spark, d).movies, ["title", "genres"])


@query("similar_for_targets")
def _q_sim_targets(spark, d):
    t = load_tables(spark, d)
    targets = t.tags.select((F.col("movieId") * 30).alias("movieId")).distinct()
    return SIM.similar_by_genres(t.movies, TOP_N, targets=targets)


@query("user_history_for_users")
def _q_history_users(spark, d):
    t = load_tables(spark, d)
    return X.user_history(t.ratings, t.movies, t.tags.select((F.col("userId") * 7).alias("userId")))


@query("fallback_titles")
def _q_fallback_titles(spark, d):
    t = load_tables(spark, d)
    top = P.most_rated_inner(t.movies, t.ratings, TOP_N)
    return top.agg(join_ranked("rank", "title").alias("titles"))


def _fits_at_once(spark, n_rows):
    """A small fit is a chain of short stages of a few tasks each: as many fits as task slots, within
    what one driver can plan, fill the slots. A large one keeps a slot a block busy; as many as that
    fills, since each has its shuffle files and blocks on disk."""
    slots = spark.sparkContext.defaultParallelism
    return max(1, slots // ALSOPS.MOST_BLOCKS) if n_rows >= ALSOPS.LARGE_FIT else max(4, min(16, slots))


@query("als_tuning_report")
def _q_als_tuning(spark, d):
    _, train, test = _train_test(spark, d)

    def fit(rows, p):
        return ALSOPS.fit_als(rows, p["rank"], p["maxIter"], p["regParam"])

    def evaluate(model, rows):
        return ALSOPS.rmse(ALSOPS.predict(model, rows))

    def fold_eval(shared, p):
        return ALSOPS.rating_fold_rmse(shared, p["rank"], p["maxIter"], p["regParam"])
    return TUNE.tune(train, test, TUNE.als_grid(), fit, evaluate, n_folds=4, parallelism=_fits_at_once(spark, train.count()),
                     prepare=ALSOPS.rating_fold, fold_eval=fold_eval)


@query("biased_mf_tuning_report")
def _q_bmf_tuning(spark, d):
    _, train, test = _train_test(spark, d)

    def fit(rows, p):
        return BMF.fit_biased_mf(rows, p["rank"], p["maxIter"], p["regParam"])

    def evaluate(model, rows):
        return ALSOPS.rmse(BMF.predict_biased(model, rows), prediction="estimate")

    def prepare(fit_rows, eval_rows):
        return BMF.bias_fold(fit_rows, eval_rows, blocks=blocks)

    def fold_eval(shared, ps):
        return BMF.fold_rmses(shared, ps[0]["rank"], [p["maxIter"] for p in ps], ps[0]["regParam"], blocks=blocks)

    def together(p):  # 10, 20 and 30 iterations are stages of one fit; the largest rank begins first
        return -p["rank"], p["regParam"]
    slots = spark.sparkContext.defaultParallelism
    blocks = max(-(-slots // 4), -(-train.count() // ALSOPS.RATINGS_PER_BLOCK))
    return TUNE.tune(train, test, TUNE.svd_grid_as_als(), fit, evaluate, n_folds=5, parallelism=9,
                     prepare=prepare, fold_eval=fold_eval, together=together)


@query("sgd_mf_rmse")
def _q_sgd_rmse(spark, d):
    _, train, test = _train_test(spark, d)
    return ALSOPS.rmse_frame(BMF.predict_biased(SGD.fit_sgd(train), test), prediction="estimate")


@query("sgd_tuning_report")
def _q_sgd_tuning(spark, d):
    """The original grid: 81 points, 5 folds; the best point again on all training rows."""
    _, train, test = _train_test(spark, d)
    report = materialize(SGD.tune_sgd(train, TUNE.svd_grid(), 5), "sgd-report")
    best = TUNE.best_params(report)
    model = SGD.fit_sgd(train, best["n_factors"], best["n_epochs"], best["lr_all"], best["reg_all"])
    held_out = ALSOPS.rmse(BMF.predict_biased(model, test), prediction="estimate")
    return report.withColumn("test_rmse", F.when(F.col("is_best"), F.lit(held_out)))


# CSV: the four tables written, broken lines among them, and read back ------------------
def _csv_tables(spark, d):
    """``table -> (rows, rejects)`` of the CSV form of the tables, with titles that hold quotes, commas
    and line breaks, and three broken lines for every tenth movie."""
    t = load_tables(spark, d)
    epoch = F.unix_timestamp("ts").cast("bigint").alias("timestamp")
    hostile = F.concat(F.lit('"'), F.col("title"), F.lit('", '), F.col("movieId"), F.lit('\n,""\\ '))
    frames = {
        "ratings": t.ratings.select("userId", "movieId", "rating", epoch),
        "movies": t.movies.select("movieId", hostile.alias("title"), "genres"),
        "links": t.links,
        "tags": t.tags.select("userId", F.coalesce("movieId", F.lit(0)).alias("movieId"), "tag", epoch),
    }
    tenth = t.movies.where(F.col("movieId") % 10 == 0).select(F.col("movieId").cast("string").alias("m"))
    broken = {
        "movies": [F.concat(F.col("m"), F.lit(",lost"))],
        "ratings": [F.concat(F.lit("u"), F.col("m"), F.lit(","), F.col("m"), F.lit(",4.5,0")),
                    F.concat(F.lit(","), F.col("m"), F.lit(",4.5,0"))],
    }
    out = {}
    for name, df in frames.items():
        path = scratch_path(spark, f"csv-{name}-{uuid.uuid4().hex}")
        write_csv(df, path, header=False)
        for line in broken.get(name, []):
            tenth.select(line).write.mode("append").text(path)
        record_scratch(spark, path)
        out[name] = read_csv_checked(spark, path, name, header=False)
    return out


@query("csv_movies")
def _q_csv_movies(spark, d):
    return _csv_tables(spark, d)["movies"][0]


@query("csv_rejects")
def _q_csv_rejects(spark, d):
    parts = [rejects.select(F.lit(name).alias("table_name"), "line", "reason")
             for name, (_, rejects) in _csv_tables(spark, d).items()]
    return reduce(DataFrame.unionByName, parts)


@query("csv_report")
def _q_csv_report(spark, d):
    return QC.table_report({name: rows for name, (rows, _) in _csv_tables(spark, d).items()})
