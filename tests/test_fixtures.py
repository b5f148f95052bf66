"""Hand-made tables for the edge cases of the exploration and lookup operators."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tastemap.operators import explore as X
from tastemap.operators import genres as G
from tastemap.operators import popularity as P
from tastemap.operators import quality as QC
from tastemap.operators import similarity as SIM
from tastemap.sources import read_csv_raw, read_csv_typed, register_views

MOVIES = [(1, "A (1995)", "Drama|Drama|War"), (2, "B (1996)", "(no genres listed)"),
          (3, "C (1997)", ""), (4, "D (1998)", None), (5, "A (1995)", "Comedy"),
          (6, "Tagged only (2000)", "Drama")]


@pytest.fixture()
def movies(spark):
    return spark.createDataFrame(MOVIES, "movieId bigint, title string, genres string")


@pytest.fixture()
def ratings(spark):
    rows = [(10, 1, 4.0), (11, 1, 3.0), (10, 2, 5.0), (12, 5, 2.0), (12, 3, 1.0)]
    return spark.createDataFrame(rows, "userId bigint, movieId bigint, rating double")


def test_not_in_with_null_key_is_empty_but_anti_join_is_not(spark, movies, ratings):
    with_null = ratings.unionByName(spark.createDataFrame([(13, None, 3.0)], ratings.schema))
    assert X.unrated_items_not_in(movies, with_null).count() == 0
    assert sorted(r["movieId"] for r in X.unrated_items_not_in(movies, ratings).collect()) == [4, 6]
    assert X.unrated_items_not_in(movies, ratings.limit(0)).count() == movies.count()
    odd = movies.unionByName(spark.createDataFrame([(None, "No id", "Drama")], movies.schema))
    assert X.unrated_items_not_in(odd, ratings).count() == 2
    assert X.unrated_items_not_in(odd, ratings.limit(0)).count() == odd.count()
    ids = sorted(r["movieId"] for r in X.unrated_items(movies, with_null).collect())
    assert ids == [4, 6]


def test_malformed_rating_is_null_dropped_and_counted(spark):
    raw = spark.createDataFrame([("1", "2", "4.5", "0"), ("1", "3", "bad", "0")],
                                "userId string, movieId string, rating string, timestamp string")
    typed = raw.select(*[F.col(c).try_cast(t).alias(c) for c, t in
                         [("userId", "int"), ("movieId", "int"), ("rating", "float"),
                          ("timestamp", "bigint")]])
    report = QC.table_report({"ratings": typed}).collect()[0]
    assert (report["n_rows"], report["n_rejected"]) == (2, 1)
    assert QC.clean_ratings(typed).count() == 1


def test_quoted_title_is_one_field(spark):
    d = tempfile.mkdtemp(prefix="tastemap-csv-")
    path = os.path.join(d, "movies.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('movieId,title,genres\n1,"A ""q"", The",Drama|War\n2,Plain,Comedy\n')
    rows = read_csv_raw(spark, path).orderBy("movieId").collect()
    assert rows[0]["title"] == 'A "q", The'
    assert rows[0]["genres"] == "Drama|War"
    typed = read_csv_typed(spark, path, "movies")
    assert dict(typed.dtypes)["movieId"] == "bigint"


def test_genre_sets(spark, movies):
    got = {r["movieId"]: r["genre"] for r in G.movie_genres(movies).groupBy("movieId")
           .agg(F.array_sort(F.collect_list("genre")).alias("genre")).collect()}
    assert got[1] == ["Drama", "War"]
    assert got[2] == ["(no genres listed)"]
    assert 3 not in got and 4 not in got
    counts = {r["category"]: r["number"] for r in X.genre_counts(movies).collect()}
    assert counts == {"Drama": 2, "War": 1, "(no genres listed)": 1, "Comedy": 1}
    vocab = G.collect_vocabulary(movies)
    flags = {r["movieId"]: r["flags"] for r in G.genre_flags(movies, vocab).collect()}
    assert flags[4] == [0] * len(vocab)
    assert sum(flags[1]) == 2


def test_title_collision_merged(spark, movies, ratings):
    top = {r["title"]: r["count"] for r in X.top_reviewed(movies, ratings, 100).collect()}
    assert top["A (1995)"] == 3          # ids 1 and 5 share the title
    rated = {r["title"]: (r["rate"], r["count"]) for r in X.top_rated(movies, ratings, 100).collect()}
    assert rated["A (1995)"] == (3.0, 3)
    assert rated["D (1998)"] == (None, 0)


def test_tag_only_item_is_unrated(spark, movies, ratings):
    ids = {r["movieId"] for r in X.unrated_items(movies, ratings).collect()}
    assert 6 in ids


def test_ties_break_by_id(spark, movies, ratings):
    rows = P.most_rated_left(movies, ratings, 6).orderBy("rank").collect()
    assert [r["movieId"] for r in rows] == [1, 2, 3, 5, 4, 6]
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5, 6]


def test_few_items_gives_all_ranks(spark, movies, ratings):
    rows = P.most_rated_inner(movies, ratings, 50).collect()
    assert sorted(r["rank"] for r in rows) == [1, 2, 3, 4]


def test_empty_table_fails_with_its_name(spark, movies):
    empty = spark.createDataFrame([], "userId int, movieId int, rating float")
    with pytest.raises(QC.EmptyTableError, match="ratings"):
        QC.validate({"movies": movies, "ratings": empty})


def test_zero_vector_similarity_is_null_and_last(spark):
    f = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.5, 0.5]), (4, [0.0, 1.0])],
                              "id int, features array<float>")
    rows = SIM.similar_by_factors(f, 3, targets=spark.createDataFrame([(1,), (99,)], "id int")) \
        .orderBy("target_id", "rank").collect()
    t1 = [r for r in rows if r["target_id"] == 1]
    assert [r["movieId"] for r in t1] == [3, 4, 2]
    assert t1[-1]["similarity"] is None
    unknown = [r for r in rows if r["target_id"] == 99]
    assert len(unknown) == 1 and unknown[0]["is_known"] is False and unknown[0]["movieId"] is None


def test_user_history_batch(spark, movies, ratings):
    users = spark.createDataFrame([(10,), (99,)], "userId bigint")
    rows = X.user_history(ratings, movies, users).collect()
    assert [(r["userId"], r["movieId"], r["rating"]) for r in rows] == [(10, 2, 5.0), (10, 1, 4.0)]
    assert rows[0]["title"] == "B (1996)"


def test_describe_numeric(spark, ratings):
    rows = {r["column_name"]: r for r in QC.describe_numeric(ratings, ["rating"]).collect()}
    assert rows["rating"]["n"] == 5 and rows["rating"]["max"] == 5.0 and rows["rating"]["min"] == 1.0


def test_sql_entry_with_parameter_markers(spark, movies, ratings):
    register_views(spark, {"movies": movies, "ratings": ratings})
    text = """SELECT r.userId, r.movieId, r.rating, m.title FROM ratings AS r
              LEFT JOIN movies AS m USING (movieId) WHERE r.userId = :uid ORDER BY r.rating DESC"""
    rows = X.run_sql(spark, text, uid=10).collect()
    assert [(r["movieId"], r["rating"]) for r in rows] == [(2, 5.0), (1, 4.0)]
    # a 16-digit id matches nothing and does not fail
    assert X.run_sql(spark, text, uid=1111111111111111).count() == 0


def test_wide_onehot_and_materialize(spark, movies):
    from tastemap.session import materialize
    vocab = G.collect_vocabulary(movies)
    wide = G.genre_onehot_wide(movies, vocab)
    assert wide.columns == ["movieId", "title"] + vocab
    row = {r["movieId"]: r for r in wide.collect()}[1]
    assert (row["Drama"], row["War"], row["Comedy"]) == (1, 1, 0)
    stored = materialize(wide, "wide-test")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, wide.collect()))
    assert spark.conf.get("spark.checkpoint.dir") in stored.inputFiles()[0]


def test_ids_beyond_32_bits_lose_no_row(spark):
    from tastemap.operators import als as A
    far = 1 << 40
    rows = [(u + far, i - far, float((u * i) % 5 + 1)) for u in range(8) for i in range(8)]
    df = spark.createDataFrame(rows, "userId bigint, movieId bigint, rating double")
    clean = QC.clean_ratings(df)
    assert clean.count() == 64
    assert QC.rejected_ratings(df).first()["n_rejected"] == 0
    model = A.fit_als(clean, rank=2, max_iter=2)
    assert A.predict(model, clean).count() == 64
    assert {r["id"] for r in model.userFactors.collect()} == {u + far for u in range(8)}


def test_repeated_requests_get_their_own_titles(spark):
    from tastemap.operators import biased_mf as B
    from tastemap.operators import serving as S
    ratings = spark.createDataFrame([(u, i, float(i % 5 + 1)) for u in (1, 2) for i in range(1, 7)],
                                    "userId bigint, movieId bigint, rating float")
    movies = spark.createDataFrame([(i, f"m{i}", "x") for i in range(1, 7)], "movieId bigint, title string, genres string")
    req = spark.createDataFrame([(1, 3), (1, 3), (1, 2), (9, 2), (None, 2), (2, 0)], "userId bigint, n int")
    rows = S.serve(req, B.fit_biased_mf(ratings, rank=0), movies, ratings).collect()
    assert len(rows) == 6
    same = [r["titles"] for r in rows if (r["userId"], r["n"]) == (1, 3)]
    assert len(same) == 2 and same[0] == same[1] and len(set(same[0].split(" | "))) == 3
    assert sorted(r["status"] for r in rows) == ["fallback", "invalid", "invalid", "ok", "ok", "ok"]


def test_checkpoint_folder_override_and_clean_up(spark):
    from tastemap import session
    df = session.materialize(spark.range(3).toDF("id"), "clean")
    path = session._written[-1][1]
    assert df.count() == 3 and path.startswith(session.ensure_checkpoint_dir(spark))
    assert os.path.exists(path.removeprefix("file:"))
    assert session.clean_up(spark) >= 1
    assert not os.path.exists(path.removeprefix("file:"))


@pytest.mark.parametrize("bound", [10_000, 3])
def test_huge_n_gives_every_movie_once(spark, monkeypatch, bound):
    from tastemap.operators import biased_mf as B
    from tastemap.operators import serving as S
    monkeypatch.setattr(S, "LIST_BOUND", bound)
    ratings = spark.createDataFrame([(u, i, float(i % 5 + 1)) for u in (1, 2) for i in range(1, 7)],
                                    "userId bigint, movieId bigint, rating float")
    movies = spark.createDataFrame([(i, f"m{i}", "x") for i in range(1, 7)], "movieId bigint, title string, genres string")
    req = spark.createDataFrame([(1, 2_000_000_000), (9, 2_000_000_000), (8, 4), (8, 4)], "userId bigint, n int")
    got = sorted((r["userId"], r["status"], len(r["titles"].split(" | "))) for r in
                 S.serve(req, B.fit_biased_mf(ratings, rank=0), movies, ratings).collect())
    assert got == [(1, "ok", 6), (8, "fallback", 4), (8, "fallback", 4), (9, "fallback", 6)]
