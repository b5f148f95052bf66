"""CSV sources end to end: write the four tables as CSV, read them back, run queries."""

import os
import tempfile

from pyspark.sql import functions as F

from tastemap.operators import explore as X
from tastemap.operators import quality as QC
from tastemap.sources import read_tables_csv
from tastemap.sources.csv import read_csv_checked, read_csv_typed
from tastemap.sources.schemas import SCHEMAS
from tastemap.sources.views import load_tables
from tests.conftest import SF_SMALL

QUOTED = 'A "q", The (1999)'


def test_csv_round_trip_and_queries(spark):
    t = load_tables(spark, SF_SMALL)
    epoch = F.unix_timestamp("ts").cast("bigint").alias("timestamp")
    frames = {
        "ratings": t.ratings.select("userId", "movieId", "rating", epoch),
        "movies": t.movies.unionByName(spark.createDataFrame(
            [(999999, QUOTED, "Drama|War")], "movieId bigint, title string, genres string")),
        "links": t.links,
        "tags": t.tags.select("userId", "movieId", "tag", epoch),
    }
    folder = tempfile.mkdtemp(prefix="tastemap-csv-")
    for name, df in frames.items():
        df.write.option("header", True).option("escape", '"').csv(os.path.join(folder, f"{name}.csv"))

    typed = read_tables_csv(spark, folder)
    for name, df in typed.items():
        assert df.schema.simpleString() == SCHEMAS[name].simpleString().replace("not null", "")
    report = {r["table_name"]: (r["n_rows"], r["n_rejected"]) for r in QC.validate(typed).collect()}
    assert report["ratings"] == (frames["ratings"].count(), 0)
    assert report["movies"][0] == frames["movies"].count()
    titles = [r["title"] for r in typed["movies"].where(F.col("movieId") == 999999).collect()]
    assert titles == [QUOTED]

    def rows(df):
        return sorted(tuple(r) for r in df.collect())
    assert rows(X.rating_histogram(typed["ratings"])) == rows(X.rating_histogram(t.ratings))
    assert rows(X.top_reviewed(typed["movies"], typed["ratings"], 20)) == \
        rows(X.top_reviewed(t.movies, t.ratings, 20))
    assert rows(X.item_count(typed["movies"], typed["ratings"], typed["links"], typed["tags"])) == \
        [(frames["movies"].count(),)]
    unrated = {r["movieId"] for r in X.unrated_items(typed["movies"], typed["ratings"]).collect()}
    assert 999999 in unrated


def test_wide_ids_are_kept(spark):
    folder = tempfile.mkdtemp(prefix="tastemap-csv-")
    path = os.path.join(folder, "ratings.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("userId,movieId,rating,timestamp\n9007199254740993,4294967296,4.5,0\n99999999999999999999,1,2.0,0\n")
    typed = read_csv_typed(spark, path, "ratings")
    assert sorted((r["userId"] or 0, r["movieId"]) for r in typed.collect()) == [(0, 1), (9007199254740993, 4294967296)]
    assert QC.clean_ratings(typed).count() == 1


def test_rejects_are_kept_with_file_and_reason(spark):
    folder = tempfile.mkdtemp(prefix="tastemap-csv-")
    path = os.path.join(folder, "movies.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('movieId,title,genres\n1,"two\nlines, ""quoted""",Drama\n2,short\n3,too,many,fields\nx,name,Drama\n'
                 ',nobody,Drama\n4,,Drama\n5, spaced ,\n')
    rows, rejects = read_csv_checked(spark, path, "movies")
    assert sorted(map(tuple, rows.collect())) == [(1, 'two\nlines, "quoted"', "Drama"), (5, " spaced ", None)]
    assert rows.schema.simpleString() == SCHEMAS["movies"].simpleString()
    got = rejects.collect()
    assert sorted((r["line"], r["reason"]) for r in got) == [
        (",nobody,Drama", "movieId: missing"), ("2,short", "fields"), ("3,too,many,fields", "fields"),
        ("4,,Drama", "title: missing"), ("x,name,Drama", "movieId: not a bigint")]
    assert all(r["file"].endswith("movies.csv") for r in got)
    assert rows.count() + rejects.count() == 7

    empty = os.path.join(folder, "empty.csv")
    open(empty, "w").close()
    rows, rejects = read_csv_checked(spark, empty, "ratings")
    assert rows.count() == rejects.count() == 0
