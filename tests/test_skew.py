"""Hot keys: one user and one item each hold about a third of all ratings.

Results must stay whole and exact; the plans must not depend on a hot group
fitting one task (checked here functionally against pandas on a small table
split over many partitions).
"""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tastemap.operators import explore as X
from tastemap.operators import popularity as P
from tastemap.operators import similarity as SIM


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(17)
    n = 3000
    users = np.where(rng.random(n) < 0.34, 1, rng.integers(2, 200, n))
    items = np.where(rng.random(n) < 0.34, 1, rng.integers(2, 120, n))
    ratings = pd.DataFrame({"userId": users, "movieId": items,
                            "rating": rng.integers(1, 11, n) * 0.5}).drop_duplicates(["userId", "movieId"])
    movies = pd.DataFrame({"movieId": np.arange(1, 130),
                           "title": [f"t{i % 97}" for i in range(1, 130)],
                           "genres": ["a|b" if i % 3 else "a" for i in range(1, 130)]})
    r = spark.createDataFrame(ratings).repartition(16)
    m = spark.createDataFrame(movies).repartition(4)
    return ratings, movies, r, m


def test_counts_and_tops_under_skew(spark, skewed):
    ratings, movies, r, m = skewed
    per_user = ratings.groupby("userId").size()
    got = {row["stat"]: row["value"] for row in X.min_ratings_per_key(r).collect()}
    assert got["min_ratings_per_user"] == per_user.min()

    joined = movies.merge(ratings, on="movieId", how="left")
    want = (joined.assign(rated=joined["rating"].notna().astype(int)).groupby("title")["rated"].sum()
            .reset_index().sort_values(["rated", "title"], ascending=[False, True]).head(20))
    top = X.top_reviewed(m, r, 20).orderBy("rank").collect()
    assert [(t["title"], t["count"]) for t in top] == list(zip(want["title"], want["rated"]))

    fb = P.most_rated_left(m, r, 5).orderBy("rank").collect()
    assert fb[0]["movieId"] == 1 and fb[0]["n_ratings"] == (ratings["movieId"] == 1).sum()


def test_history_sort_keeps_every_row_of_the_hot_user(spark, skewed):
    ratings, _, r, m = skewed
    rows = X.user_history(r, m).collect()
    assert len(rows) == len(ratings)
    hot = [(x["rating"], x["movieId"]) for x in rows if x["userId"] == 1]
    assert len(hot) == (ratings["userId"] == 1).sum()
    assert hot == sorted(hot, key=lambda t: (-t[0], t[1]))


def test_genre_similarity_with_a_dominant_set(spark, skewed):
    _, movies, _, m = skewed
    got = SIM.similar_by_genres(m, 5).collect()
    assert len(got) == len(movies) * 5
    by_target = {}
    for row in got:
        by_target.setdefault(row["target_id"], []).append(row)
    # target 1 has genres "a|b"; its nearest are the other "a|b" items in id order
    first = sorted(by_target[1], key=lambda x: x["rank"])
    assert [x["movieId"] for x in first] == [2, 4, 5, 7, 8]
    assert all(x["similarity"] == 1.0 for x in first)
