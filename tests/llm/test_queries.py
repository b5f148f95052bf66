"""Registered queries: SQL oracles at sf0.01, the WARC reader on hostile archives, and the
pipeline stage by stage against plain Python."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tastemap.llm import catalog, minhash, warc
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_duckdb(spark, name):
    res = compare(spark, name, catalog.QUERIES[name], catalog.ORACLES[name], SF, duck(SF))
    assert res["cols_ok"] and res["hash_ok"] and res["rows_spark"] == res["rows_duck"], res


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


def test_warc_round_trip_with_magic_inside_payloads(spark, tmp_path):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    html = ["plain", None, "", "x" * 1500, "x" * 1500, "é" * 700, "before " + inner + inner + " after", inner,
            "WARC/1.1\r\n", "y" * 30 + "WARC/1.1\r\nContent-Length: 99999\r\n\r\n" + "z" * 4000, "tail WARC/1.1\r",
            "x" * 1500, inner * 20]
    rows = [(k, f"http://a/{k}\r\nWARC-Type: x", h) for k, h in enumerate(html)] + [(None, None, "no id"), (None, "u", "x" * 1500)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)).repartition(2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("1500", before):  # splits smaller than a record, and whole files
        path = str(tmp_path / f"warc-{size}")
        warc.write_archives(df, path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = collections.Counter((r["page_id"], r["bytes"], r["digest"], r["kind"], r["refers_to"])
                                      for r in warc.read_archives(spark, path).collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        want = collections.Counter()
        for k, _, h in rows:
            b = (h or "").encode()
            target = 11 if h == "x" * 1500 and k != 11 else None
            want[(k, len(b), hashlib.sha1(b).hexdigest(), "revisit" if target else "response", target)] += 1
        assert got == want
    empty = str(tmp_path / "warc-empty")
    warc.write_archives(df.limit(0), empty)


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "secrets", "packing"]
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    told = catalog.quality.quality_report(docs).where("kept")
    assert kept.columns == columns and {r[0] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in told.collect()}
    one = corpus_pipeline.near_dedup(spark, docs, SF)
    assert one.columns == columns
    assert sorted(r[0] for r in one.select("doc_id").collect()) == sorted(
        r["doc_id"] for r in minhash.near_duplicates(docs, percent=80).where("kept").collect())
    clean = corpus_pipeline.decontamination(spark, docs, SF)
    hit = catalog.decontaminate.scan_documents(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated")
    bad = {r["doc_id"] for r in hit.collect()}
    assert bad and clean.columns == columns
    assert {r[0] for r in clean.select("doc_id").collect()} == {r[0] for r in docs.select("doc_id").collect()} - bad
    masked = {r["doc_id"]: r for r in corpus_pipeline.secrets(spark, docs, SF).collect()}
    for r in docs.collect():
        assert masked[r["doc_id"]]["text"] == catalog.secrets.redact(r["text"]) and len(masked) == docs.count()
    packed = corpus_pipeline.packing(spark, docs, SF)
    assert {r[0] for r in packed.select("doc_id").collect()} == set(masked)


def test_repeated_rows_leave_one(spark):
    rows = [(1, "some words here and there now", "a"), (1, "some words here and there now", "b"), (2, None, "c"), (2, None, "c"),
            (1, "other text under the same id", "d"), (None, "no id here at all you see", "e")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _hash string")
    left = minhash.keep_representatives(df.withColumnRenamed("_hash", "extra")).collect()
    assert collections.Counter(r["text"] for r in left) == {"some words here and there now": 1, None: 2,
                                                            "other text under the same id": 1, "no id here at all you see": 1}


def near_pairs(spark, n, width, changes):
    """Pairs of documents (2k, 2k + 1) and the similarity of their 5-word sets by the second's id."""
    rows, at = [], {}
    for k in range(n):
        words, changed = [f"w{k}x{i}" for i in range(width + 4)], changes[k % len(changes)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:-changed] + [f"new{k}x{i}" for i in range(changed)]))]
        at[2 * k + 1] = (width - changed) / (width + changed)
    return spark.createDataFrame(rows, "doc_id bigint, text string"), at


def test_near_copies_at_080(spark):
    df, at = near_pairs(spark, 120, 100, (8, 9, 10, 11, 12))  # 0.85, 0.83, 0.82, 0.80, 0.79
    for percent in (80, 85):
        left = {r["doc_id"] for r in minhash.keep_representatives(df, percent=percent).collect()}
        assert left == {2 * k for k in range(120)} | {i for i, s in at.items() if 100 * s < percent}


def test_lower_thresholds_miss_no_pair(spark):
    df, at = near_pairs(spark, 3000, 300, (52,))  # 248 / 352; 20 bands miss one in 290
    assert min(at.values()) > 0.70
    assert minhash.near_duplicates(df, percent=70).where("kept").count() == 3000


def test_bands_follow_the_threshold():
    assert minhash.band_count() == 20 and minhash.band_count(80) == 28 and minhash.band_count(100) == 1
    for percent in range(70, 100):
        assert (1 - (percent / 100) ** minhash.ROWS) ** minhash.band_count(percent) <= minhash.MISS
    with pytest.raises(ValueError):
        minhash.band_count(60)
