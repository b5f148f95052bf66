"""Model invariants on planted data and on the driver tables."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemap.operators import als as A
from tastemap.operators import biased_mf as B
from tastemap.operators import serving as S
from tastemap.operators import tuning as T


@pytest.fixture(scope="module")
def planted(spark):
    """200 users x 100 items, rank 3 plus small noise, 30 % observed, fixed seed."""
    rng = np.random.default_rng(5)
    u = rng.normal(size=(200, 3))
    v = rng.normal(size=(100, 3))
    full = 3.0 + u @ v.T * 0.6 + rng.normal(scale=0.1, size=(200, 100))
    mask = rng.random((200, 100)) < 0.3
    rows = [(int(i), int(j), float(np.clip(full[i, j], 0.5, 5.0)))
            for i, j in zip(*np.nonzero(mask))]
    return spark.createDataFrame(rows, "userId int, movieId int, rating float")


@pytest.fixture(scope="module")
def movies(spark):
    return spark.createDataFrame([(i, f"m{i}", "x|y" if i % 2 else "y") for i in range(105)],
                                 "movieId int, title string, genres string")


def test_biased_mf_beats_mean_on_planted_data(spark, planted):
    train, test = A.split_hash(planted, 5, 0)
    mu = train.agg(F.avg("rating")).first()[0]
    mean_rmse = test.agg(F.sqrt(F.avg((F.col("rating") - F.lit(mu)) ** 2))).first()[0]
    model = B.fit_biased_mf(train, rank=3, max_iter=10, reg_param=0.05, rating_scale=(0.5, 5.0))
    pred = B.predict_biased(model, test)
    assert pred.count() == test.count()          # every held-out row kept
    assert A.rmse(pred, prediction="estimate") < 0.8 * mean_rmse


def test_als_beats_mean_on_planted_data(spark, planted):
    train, test = A.split_hash(planted, 5, 0)
    mu = train.agg(F.avg("rating")).first()[0]
    mean_rmse = test.agg(F.sqrt(F.avg((F.col("rating") - F.lit(mu)) ** 2))).first()[0]
    m = A.fit_als(train, rank=3, max_iter=10, reg_param=0.05)
    assert A.rmse(A.predict(m, test)) < 0.8 * mean_rmse


def test_recommend_biased_invariants(spark, planted, movies):
    model = B.fit_biased_mf(planted, rank=3, max_iter=5, reg_param=0.05)
    users = spark.createDataFrame([(0,), (1,), (5000,), (2222222222222222,)], "userId bigint")
    recs = B.recommend_biased(model, users, movies, 7).collect()
    by_user = {}
    for r in recs:
        by_user.setdefault(r["userId"], []).append(r)
    assert set(by_user) == {0, 1, 5000, 2222222222222222}
    for rows in by_user.values():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 8))
        est = [r["estimate_rating"] for r in rows]
        assert all(a >= b for a, b in zip(est, est[1:]))
        assert all(1.0 <= e <= 5.0 for e in est)
    # exact against a brute-force scoring of every movie row
    pred = B.predict_biased(model, movies.select(F.lit(0).alias("userId"), "movieId"), raw=True)
    best = pred.orderBy(F.col("raw_estimate").desc(), "movieId").limit(7).collect()
    assert [r["movieId"] for r in best] == [r["movieId"] for r in sorted(by_user[0], key=lambda r: r["rank"])]
    # unknown user: mu + b_i ordering
    unknown = sorted(by_user[5000], key=lambda r: r["rank"])
    bi = model.item_bias.orderBy(F.col("b_i").desc(), "movieId").limit(7).collect()
    assert [r["movieId"] for r in unknown] == [r["movieId"] for r in bi]


def test_als_recommend_and_fallback(spark, planted, movies):
    m = A.fit_als(planted, rank=3, max_iter=5, reg_param=0.05)
    users = spark.createDataFrame([(0,), (1111111111111111,)], "userId bigint")
    rows = A.recommend_for_users(m, users, 5, movies, planted).collect()
    known = [r for r in rows if r["is_known"]]
    unknown = [r for r in rows if not r["is_known"]]
    assert {r["userId"] for r in known} == {0}
    assert sorted(r["rank"] for r in known) == [1, 2, 3, 4, 5]
    # the 16-digit id does not fit an int: no overflow error, it is simply unknown
    assert {r["userId"] for r in unknown} == {1111111111111111}
    assert sorted(r["rank"] for r in unknown) == [1, 2, 3, 4, 5]
    users2 = spark.createDataFrame([(0,), (4242,)], "userId int")
    rows2 = A.recommend_for_users(m, users2, 5, movies, planted).collect()
    fb = sorted([r for r in rows2 if r["userId"] == 4242], key=lambda r: r["rank"])
    assert [r["rank"] for r in fb] == [1, 2, 3, 4, 5]
    assert all(r["predicted_rating"] is None for r in fb)


def test_same_seed_same_factors_and_save_load(spark, planted, movies):
    m1 = A.fit_als(planted, rank=3, max_iter=3, reg_param=0.1, seed=1)
    m2 = A.fit_als(planted, rank=3, max_iter=3, reg_param=0.1, seed=1)
    f1 = {r["id"]: r["features"] for r in m1.itemFactors.collect()}
    f2 = {r["id"]: r["features"] for r in m2.itemFactors.collect()}
    assert f1.keys() == f2.keys()
    assert all(np.allclose(f1[k], f2[k], atol=1e-5) for k in f1)
    path = tempfile.mkdtemp(prefix="tastemap-model-")
    A.save_model(m1, os.path.join(path, "als"))
    m3 = A.load_model(spark, os.path.join(path, "als"))
    p1 = A.predict(m1, planted).select("userId", "movieId", "prediction").orderBy("userId", "movieId").collect()
    p3 = A.predict(m3, planted).select("userId", "movieId", "prediction").orderBy("userId", "movieId").collect()
    assert p1 == p3
    bm = B.fit_biased_mf(planted, rank=3, max_iter=3, reg_param=0.1)
    B.save_biased(bm, os.path.join(path, "bmf"))
    bm2 = B.load_biased(spark, os.path.join(path, "bmf"))
    e1 = B.predict_biased(bm, planted).orderBy("userId", "movieId").select("estimate").collect()
    e2 = B.predict_biased(bm2, planted).orderBy("userId", "movieId").select("estimate").collect()
    assert np.allclose([r[0] for r in e1], [r[0] for r in e2])


def test_serving_known_and_unknown(spark, planted, movies):
    model = B.fit_biased_mf(planted, rank=3, max_iter=3, reg_param=0.1)
    req = spark.createDataFrame([(0, 3), (9999, 2)], "userId bigint, n int")
    rows = {r["userId"]: r for r in S.serve(req, model, movies, planted).collect()}
    assert rows[0]["is_known"] and len(rows[0]["titles"].split(" | ")) == 3
    assert not rows[9999]["is_known"] and len(rows[9999]["titles"].split(" | ")) == 2


def test_user_only_in_held_out_rows_scores_mu_plus_bi(spark, planted, movies):
    train = planted.where(F.col("userId") != 7)
    model = B.fit_biased_mf(train, rank=3, max_iter=3, reg_param=0.1)
    rows = B.recommend_biased(model, spark.createDataFrame([(7,)], "userId int"), movies, 3).collect()
    bi = {r["movieId"]: r["b_i"] for r in model.item_bias.collect()}
    for r in rows:
        assert r["estimate_rating"] == pytest.approx(min(5.0, max(1.0, model.mu + bi.get(r["movieId"], 0.0))))


def test_cross_validation_report(spark, planted):
    points = T.grid(rank=[2, 3], maxIter=[3], regParam=[0.1])

    def fit_eval(fit_rows, eval_rows, p):
        m = A.fit_als(fit_rows, p["rank"], p["maxIter"], p["regParam"])
        return A.rmse(A.predict(m, eval_rows))
    rep = T.cross_validate(planted, points, fit_eval, n_folds=2).collect()
    assert len(rep) == 4
    assert sum(r["is_best"] for r in rep) == 2       # both folds of the best point
    assert len(T.als_grid()) == 27 and len(T.als_grid(False)) == 81


def test_expand_alpha_and_refit(spark, planted):
    rep = spark.createDataFrame(
        [(0, '{"maxIter": 3, "rank": 2, "regParam": 0.1}', 0, 1.0, 1.0, True)],
        "grid_id int, params string, fold int, rmse double, avg_rmse double, is_best boolean")
    rows = T.expand_alpha(rep).collect()
    assert len(rows) == 3
    assert {r["params"] for r in rows} == {
        '{"maxIter":"3","rank":"2","regParam":"0.1","alpha":"%s"}' % a for a in ("0.1", "0.01", "0.001")}
    m = T.refit_best(planted, rep, lambda tr, p: A.fit_als(tr, p["rank"], p["maxIter"], p["regParam"]))
    assert m.rank == 2


def test_builtin_cross_validator(spark, planted):
    points = T.grid(rank=[2, 3], maxIter=[3], regParam=[0.1])
    model, rep = T.tune_als_builtin(planted, points, n_folds=2)
    rows = rep.collect()
    assert len(rows) == 2 and sum(r["is_best"] for r in rows) == 1
    best = [r for r in rows if r["is_best"]][0]
    assert best["avg_rmse"] == min(r["avg_rmse"] for r in rows)
    assert model.rank in (2, 3)


def test_unrated_item_scores_mu_plus_bu(spark, planted, movies):
    # movies 100..104 have no rating at all (tag-only items): no factors, no item bias
    model = B.fit_biased_mf(planted, rank=3, max_iter=3, reg_param=0.1)
    rows = B.recommend_biased(model, spark.createDataFrame([(0,)], "userId int"), movies, 105).collect()
    assert len(rows) == 105
    bu = {r["userId"]: r["b_u"] for r in model.user_bias.collect()}[0]
    for r in rows:
        if r["movieId"] >= 100:
            assert r["estimate_rating"] == pytest.approx(min(5.0, max(1.0, model.mu + bu)))


def test_als_top_k_matches_builtin_ranking(spark, planted):
    m = A.fit_als(planted, rank=3, max_iter=5, reg_param=0.05)
    ours = {}
    for r in A.recommend_all(m, 5).collect():
        ours.setdefault(r["userId"], []).append((r["rank"], r["movieId"]))
    builtin = {r["userId"]: [x["movieId"] for x in r["recommendations"]]
               for r in m.als.recommendForAllUsers(5).collect()}
    assert set(ours) == set(builtin)
    for u, recs in ours.items():
        assert [i for _, i in sorted(recs)] == builtin[u]


def test_serving_when_every_request_is_unknown(spark, planted, movies):
    model = B.fit_biased_mf(planted, rank=3, max_iter=3, reg_param=0.1)
    req = spark.createDataFrame([(7777, 2), (8888, 3)], "userId bigint, n int")
    rows = {r["userId"]: r for r in S.serve(req, model, movies, planted).collect()}
    assert set(rows) == {7777, 8888}
    assert not rows[7777]["is_known"] and len(rows[7777]["titles"].split(" | ")) == 2
    assert len(rows[8888]["titles"].split(" | ")) == 3
    empty = A.recommend_for_users(A.fit_als(planted, 2, 2, 0.1),
                                  spark.createDataFrame([(9999,)], "userId bigint"), 3, movies, planted)
    assert sorted(r["rank"] for r in empty.collect()) == [1, 2, 3]


def test_registered_reports_run_the_whole_grids(spark, monkeypatch):
    from tastemap.plans import catalog
    seen = []

    def folds_only(train, points, fit_eval, n_folds=5, parallelism=2, **_):
        seen.append((points, n_folds))
        return T.summarize(spark.createDataFrame(
            [(g, T.json.dumps(p), f, 1.0 + g) for g, p in enumerate(points[:2]) for f in range(n_folds)],
            "grid_id int, params string, fold int, rmse double"))
    monkeypatch.setattr(T, "cross_validate", folds_only)
    sf = "/root/testdata/sf0.001"
    rep = catalog.QUERIES["als_tuning_report"](spark, sf).collect()
    catalog.QUERIES["biased_mf_tuning_report"](spark, sf).collect()
    assert [(len(p), n) for p, n in seen] == [(27, 4), (27, 5)]
    assert max(p["rank"] for p in seen[0][0]) == 15 and max(p["rank"] for p in seen[1][0]) == 100
    _, train, test = catalog._train_test(spark, sf)
    best = seen[0][0][0]
    want = A.rmse(A.predict(A.fit_als(train, best["rank"], best["maxIter"], best["regParam"]), test))
    assert {r["test_rmse"] for r in rep if not r["is_best"]} == {None}
    assert [r["test_rmse"] for r in rep if r["is_best"]] == [pytest.approx(want, rel=1e-3)] * 4


def test_tune_on_train_or_all(spark, planted):
    train, test = A.split_hash(planted, 5, 0)
    n_train, n_all, fitted = train.count(), planted.count(), []

    def fit(rows, p):
        fitted.append(rows.count())
        return p["shift"] + rows.agg(F.avg("rating")).first()[0]

    def evaluate(model, rows):
        return A.rmse(rows.withColumn("prediction", F.lit(float(model))))
    for tune_on, n in (("train", n_train), ("all", n_all)):
        fitted.clear()
        rep = T.tune(train, test, T.grid(shift=[0.0, 1.0]), fit, evaluate, n_folds=2, tune_on=tune_on).collect()
        assert sum(fitted[:4]) == 2 * n and fitted[4] == n_train  # each row is in one of two folds; the refit sees train only
        assert {r["grid_id"] for r in rep if r["is_best"]} == {0} and len(rep) == 4
    with pytest.raises(ValueError):
        T.tune(train, test, [], fit, evaluate, tune_on="test")


def test_a_fit_sends_factors_to_few_blocks():
    """Shuffled factor rows grow with the blocks: 12 task slots are no reason for 12 blocks."""
    class Slots:
        defaultParallelism = 12

    class Session:
        sparkContext = Slots()
    blocks = [A.sized(A.make_als(), Session(), n).getNumUserBlocks() for n in (1000, 30_000_000, 170_000_000)]
    assert blocks == [4, 4, 6]
    assert A.sized(A.make_als(blocks=9), Session(), 1000).getNumItemBlocks() == 9


def test_fits_of_a_fold_share_its_rows(spark, planted):
    train, held_out = A.split_hash(planted, 5, 0)
    fold = A.rating_fold(train, held_out)
    try:
        got = A.rating_fold_rmse(fold, 3, 2, 0.1)
        assert fold.rows.is_cached and fold.held_out.is_cached
    finally:
        fold.release()
    want = A.rmse(A.predict(A.fit_als(train, 3, 2, 0.1), held_out))
    assert got == pytest.approx(want, rel=1e-3)


def test_bias_tables_do_not_pass_through_the_driver(spark, planted):
    from tests.test_plans import plan
    train, test = A.split_hash(planted, 5, 0)
    items = B.item_sums(train)
    mu, bi, bu = B.bias_baseline(train, 5.0, 7.0, items=items)
    assert "BroadcastHashJoin" not in plan(B.baseline_predict(mu, bi, bu, test))
    n, s = planted.where((31 * F.col("userId") + 17 * F.col("movieId")) % 5 != 0).where("movieId = 3") \
        .agg(F.count(F.lit(1)), F.sum(F.col("rating").cast("double") - mu)).first()
    assert bi.where("movieId = 3").first()["b_i"] == pytest.approx(s / (n + 5.0))
