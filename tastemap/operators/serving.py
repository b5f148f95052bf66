"""Batch serving of recommendation requests.

A request is ``(userId, n)``. Users found in the ratings table are scored by the
biased model (R3); the others get the most-rated titles (fallback B). The answer
is one row per request: ``userId, n, is_known, status, titles``, titles joined by
" | " in rank order. It is the request/response logic of a small web form run
as one Spark job over any number of requests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import one_key
from ..session import materialize
from .biased_mf import BiasedMF, recommend_biased
from .popularity import most_rated_inner

LIST_BOUND = 10_000  # titles of a fallback list that is broadcast
SALTS = 64  # tasks that share a longer one


def known_flags(requests: DataFrame, ratings: DataFrame) -> DataFrame:
    """``is_known`` per requested user, by a join with the distinct rated users."""
    users = ratings.select(F.col("userId").cast("bigint").alias("userId")).distinct() \
        .withColumn("is_known", F.lit(True))
    req = requests.withColumn("userId", F.col("userId").cast("bigint"))
    return req.join(users, "userId", "left").withColumn(
        "is_known", F.coalesce("is_known", F.lit(False)))


def _titles_up_to(titles: str, n: str) -> F.Column:
    return F.array_join(F.slice(F.col(titles), F.lit(1), F.least(F.col(n), F.size(titles))), " | ")


def serve(requests: DataFrame, model: BiasedMF, movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per request: ``userId, n, is_known, status, titles``.

    ``status``: ``ok``, ``fallback`` (unknown user) or ``invalid`` (no user, or n not
    positive; no titles). Each distinct user is scored once, in the class (power of two)
    of the largest n asked for, and the list is cut per request, so repeated requests and
    several n for one user get what each asked for. An n beyond the number of movies asks for all
    of them. The fallback list is broadcast up to LIST_BOUND titles; a longer one meets the
    requests through a shuffle on SALTS keys.
    """
    req = requests.select(F.col("userId").cast("bigint").alias("userId"), F.col("n").cast("int").alias("n"))
    valid = F.coalesce(F.col("userId").isNotNull() & (F.col("n") > 0), F.lit(False))
    flagged = materialize(known_flags(req.where(valid), ratings), "requests")
    users = flagged.where("is_known").groupBy("userId").agg(F.max("n").alias("most")) \
        .withColumn("size", F.ceil(F.log2("most")).cast("int"))
    users = materialize(users, "request-users")
    lists, n_movies = None, movies.count()
    for row in users.select("size").distinct().orderBy("size").collect():  # at most 32 classes
        part = users.where(F.col("size") == row["size"])
        recs = recommend_biased(model, part.select("userId"), movies, max(1, min(1 << row["size"], n_movies)))
        lists = recs if lists is None else lists.unionByName(recs)
    answers = []
    if lists is not None:
        per_user = lists.groupBy("userId").agg(F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "title"))), lambda x: x["title"]).alias("all_titles"))
        answers.append(flagged.where("is_known").join(per_user, "userId", "left").select(
            "userId", "n", F.lit(True).alias("is_known"), F.lit("ok").alias("status"),
            F.coalesce(_titles_up_to("all_titles", "n"), F.lit("")).alias("titles")))
    unknown = flagged.where(~F.col("is_known"))
    most = min(unknown.agg(F.max("n")).first()[0] or 0, max(1, n_movies))
    if most:  # one row of at most `most` titles
        top = most_rated_inner(movies, ratings, most).agg(F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "title"))), lambda x: x["title"]).alias("all_titles"))
        if most <= LIST_BOUND:
            asked = unknown.withColumn("_one", one_key("userId"))
            top = F.broadcast(top.withColumn("_one", one_key("all_titles")))
        else:
            asked = unknown.withColumn("_one", F.pmod(F.xxhash64("userId", "n"), F.lit(SALTS)).cast("int"))
            top = top.withColumn("_one", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        answers.append(asked.join(top, "_one").select(
            "userId", "n", F.lit(False).alias("is_known"), F.lit("fallback").alias("status"),
            _titles_up_to("all_titles", "n").alias("titles")))
    out = req.where(~valid).select("userId", "n", F.lit(False).alias("is_known"), F.lit("invalid").alias("status"),
                                   F.lit("").alias("titles"))
    for part in answers:
        out = out.unionByName(part)
    return out
