r"""Operator 6, WARC archives: written from pages, read back by boundary-chain verification.

``write_archives`` writes a record per page with Spark's text sink (any file system Spark
knows). Of records with equal payloads of ``MIN_REVISIT`` bytes or more, the one with the
largest page id is a response, the others are revisits that refer to it.

``read_archives`` never trusts the magic ``WARC/1.1`` alone, since a payload may hold it:

1. Tasks read splits of the files, cut at each magic, and emit for every candidate record
   its offset and its successor's (from the header's length). Offsets count from the start
   of the split; the split's own start is the sum of what the splits before it covered.
   Within its split a task also follows each candidate's chain to where it leaves the split.
2. The few offsets at which chains enter a split are the nodes of a short linked list per
   file. Pointer jumping (each round doubles the distance) from offset 0 keeps the reachable
   ones; rounds grow with the logarithm of the splits of the longest file.
3. In each split the records on the chain from its reachable entry are kept. Candidates off
   the chain are payload. A record that such magic or a split's edge has cut is put
   together again from its pieces in a second pass, which is skipped when there is none.

Payload digests are taken in pass 1, where the bytes are; only headers' fields and offsets
are shuffled.

Edge cases: null html is an empty payload and always a response; a null page id writes no
page id, reads back null and is never referred to (a group without any page id has no
revisits); rows that repeat the largest page id of their group are all responses; line
breaks in URLs are percent-encoded; null URLs are empty; an empty table writes no record.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemap.llm._common import read_table, stage_table
from tastemap.session import scratch_path

MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
MIN_REVISIT = 1000
_SKIP = len(MAGIC)
_PAGE = "urn:page:"


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(page: Column) -> Column:
    return F.concat(F.lit(f"<{_PAGE}"), page.cast("string"), F.lit(">"))


def _recoded(df: DataFrame, recode, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("body")
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield part.set_column(at, "body", recode(part.column(at)))
    return df.mapInArrow(run, schema)


def _zipped(page: DataFrame) -> DataFrame:
    pack = lambda c: pa.array([zstandard.compress(b) for b in c.to_pylist()], pa.binary())
    return _recoded(page.withColumn("body", F.col("body").cast("binary")), pack,
                    "page_id long, url string, body binary, digest string, size long")


def _unzipped(page: DataFrame) -> DataFrame:
    unpack = lambda c: pa.array([zstandard.decompress(b) for b in c.to_pylist()], pa.binary())
    out = _recoded(page.select("page_id", "url", "body", "digest", "size", "target"), unpack,
                   "page_id long, url string, body binary, digest string, size long, target long")
    return out.withColumn("body", F.col("body").cast("string"))


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z",
                   min_revisit: int = MIN_REVISIT) -> None:
    """Write ``page_id, url, html`` as WARC files below ``path``."""
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.replace(F.replace(F.coalesce(F.col("url"), F.lit("")), F.lit("\r"), F.lit("%0D")),
                  F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("body"))
    page = page.select("*", F.sha1(F.col("body").cast("binary")).alias("digest"),
                       F.octet_length("body").cast("long").alias("size"))
    chosen = page.where(F.col("size") >= min_revisit).groupBy("digest", "size") \
        .agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1 and target is not null").drop("n")
    # Written first, the chosen records have a known size: Spark broadcasts them under its own
    # threshold and otherwise shuffles the pages, whose payloads cross the join compressed.
    page = _zipped(page).join(stage_table(chosen, "warc-chosen"), ["digest", "size"], "left")
    page = _unzipped(page)
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("target")) & F.col("target").isNotNull(), F.lit(False))
    kind = F.when(revisit, "revisit").otherwise("response")
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                     F.col("size").cast("string"), F.lit(GAP), F.when(revisit, "").otherwise(F.col("body")))
    page = page.select("*", kind.alias("kind"), block.alias("block"), revisit.alias("is_revisit"))
    record = F.concat(
        F.lit(MAGIC), _line("WARC-Type", F.col("kind")), _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("is_revisit"), F.concat(
            _line("WARC-Refers-To", _urn(F.col("target"))),
            _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))))
        .otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"), F.col("block"))
    page.select(record.alias("value")).write.option("lineSep", GAP).text(path)


def _page_number(value: str | None) -> int | None:
    return int(value[len(_PAGE) + 1:-1]) if value and value.startswith(f"<{_PAGE}") else None


def parse_record(piece: bytes) -> dict | None:
    """Fields of the candidate whose bytes after the magic begin with ``piece``; None if its
    header isn't whole or has no length. ``size`` runs to the successor's magic."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return None
    begin, length = end + 4, int(length)
    out = {"size": begin + length + 4, "kind": fields.get("warc-type"),
           "page_id": _page_number(fields.get("warc-record-id")),
           "refers_to": _page_number(fields.get("warc-refers-to")), "whole": begin + length + 4 <= len(piece),
           "bytes": None, "digest": None}
    if out["whole"]:
        block = piece[begin:begin + length]
        http = block.find(b"\r\n\r\n") + 4 if block.startswith(b"HTTP/") else 0
        out["bytes"], out["digest"] = len(block) - http, hashlib.sha1(block[http:]).hexdigest()
        if out["kind"] == "revisit":  # its payload is elsewhere; the headers tell of it
            for line in block[:http].decode("utf-8", "replace").split("\r\n"):
                if line.lower().startswith("content-length:"):
                    out["bytes"] = int(line.partition(":")[2])
            out["digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    return out


_FIELDS = {"file": pa.string(), "block": pa.int64(), "at": pa.int64(), "covered": pa.int64(), "next": pa.int64(),
           "leaves": pa.int64(), "kind": pa.string(), "page_id": pa.int64(), "refers_to": pa.int64(),
           "whole": pa.bool_(), "bytes": pa.int64(), "digest": pa.string()}
_CANDIDATE = "file string, block long, at long, covered long, next long, leaves long, kind string, " \
             "page_id long, refers_to long, whole boolean, bytes long, digest string"


def _leaves(split: list[dict]) -> list[dict]:
    """Follow each candidate's chain to the first offset outside its split (None: it ends
    at something that is no candidate)."""
    end = sum(r["covered"] for r in split) - _SKIP  # the last magic starts the next split's first record
    exits: dict[int, int | None] = {}
    for r in reversed(split):
        out = r["next"]
        r["leaves"] = exits[r["at"]] = out if out is None or out >= end else exits.get(out)
    return split


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], int, bytes]]:
    """``(file, block), offset of the record's magic from the split's start, piece``."""
    last, at = None, 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for name, block, piece in zip(*(part.column(k).to_pylist() for k in range(3))):
                if (name, block) != last:
                    last, at = (name, block), 0
                yield last, at - _SKIP, piece
                at += len(piece) + _SKIP


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(split: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in split], t) for n, t in _FIELDS.items()],
                                          names=list(_FIELDS))
    split, last = [], None
    for key, at, piece in _splits(batches):
        if key != last and split:
            yield made(_leaves(split))
            split = []
        last = key
        row = parse_record(piece) or {"size": None, "whole": False}
        size = row.pop("size")
        split.append(row | {"file": key[0], "block": key[1], "at": at, "covered": len(piece) + _SKIP,
                            "next": None if size is None else at + _SKIP + size})
    if split:
        yield made(_leaves(split))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"))


def _reachable_entries(found: DataFrame) -> DataFrame:
    """``file, block, entry``: where the chain from each file's start enters each split."""
    ends = found.where("leaves is not null").select("file", F.col("leaves").alias("at")).distinct()
    starts = found.where("at = 0").select("file", "at")
    nodes = stage_table(found.select("file", "block", "at", "leaves").join(
        ends.union(starts).distinct(), ["file", "at"], "left_semi"), "warc-nodes")
    longest = nodes.groupBy("file").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    jump = nodes.select("file", "at", F.col("leaves").alias("to")).where("to > at")
    reached = nodes.where("at = 0").select("file", "at")
    for k in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        # Reached so far: all nodes nearer than 2^k; jump: from each node, 2^k further.
        reached = stage_table(reached.union(
            reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))).distinct(), f"warc-reach-{k}")
        step = jump.select("file", F.col("at").alias("to"), F.col("to").alias("then"))
        jump = stage_table(jump.join(step, ["file", "to"]).select("file", "at", F.col("then").alias("to")),
                           f"warc-jump-{k}")
    return nodes.join(reached, ["file", "at"], "left_semi").select("file", "block", F.col("at").alias("entry"))


def _on_chain(split: pd.DataFrame) -> pd.DataFrame:
    split = split.sort_values("at")
    entries = split["entry"].dropna()
    at = int(entries.iloc[0]) if len(entries) else None
    following = {int(a): (None if pd.isna(n) else int(n)) for a, n in zip(split["at"], split["next"])}
    kept = set()
    while at in following and at not in kept:
        kept.add(at)
        at = following[at]
    return split.assign(reached=[int(a) in kept for a in split["at"]])[["file", "block", "at", "reached"]]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record that the chain from its file's start reaches: ``file, offset, kind,
    page_id, refers_to, bytes, digest``."""
    raw = stage_table(_pieces(spark, path).mapInArrow(_candidates, _CANDIDATE), "warc-candidates")
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = raw.groupBy("file", "block").agg(F.sum("covered").alias("covered")) \
        .select("file", "block", F.coalesce(F.sum("covered").over(order), F.lit(0)).alias("base"))
    shift = lambda c: (F.col(c) + F.col("base")).alias(c)
    found = raw.join(base, ["file", "block"]).select(
        "file", "block", shift("at"), shift("next"), shift("leaves"), "kind", "page_id", "refers_to",
        "whole", "bytes", "digest", F.col("at").alias("rel"))
    candidates = found.where("at >= 0")  # before a file's first magic there is no record
    entries = _reachable_entries(candidates)
    flags = candidates.select("file", "block", "at", "next").join(entries, ["file", "block"], "left") \
        .groupBy("file", "block").applyInPandas(_on_chain, "file string, block long, at long, reached boolean")
    records = stage_table(candidates.join(flags, ["file", "block", "at"]), "warc-records")
    kept = records.where("reached")
    out = ["file", F.col("at").alias("offset"), "kind", "page_id", "refers_to", "bytes", "digest"]
    whole = kept.where("whole").select(*out)
    if kept.where("not whole").isEmpty():
        return whole
    return whole.union(_rejoined(spark, path, records).select(*out))


def _rejoined(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """Records of which a piece ends before they do, put together from all their pieces."""
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owner = lambda c: F.last(F.when(F.col("reached"), F.col(c)), ignorenulls=True).over(before)
    parts = records.select("file", "block", "rel", "at", owner("at").alias("owner"), owner("whole").alias("done")) \
        .where("not done")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (name, block), at, piece in _splits(batches):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in (
                (name, pa.string()), (block, pa.int64()), (at, pa.int64()), (piece, pa.binary()))],
                names=["file", "block", "rel", "piece"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, at, pieces in zip(*(batch.column(k).to_pylist() for k in range(3))):
                row = parse_record(MAGIC.encode().join(p["piece"] for p in pieces)) or {}
                row |= {"file": name, "at": at}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.get(n)], _FIELDS[n]) for n in _JOINED], names=list(_JOINED))

    pieces = _pieces(spark, path).mapInArrow(read, "file string, block long, rel long, piece binary") \
        .join(parts, ["file", "block", "rel"])
    grouped = pieces.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"))
    return grouped.mapInArrow(join, "file string, at long, kind string, page_id long, refers_to long, "
                                    "bytes long, digest string")


_JOINED = ("file", "at", "kind", "page_id", "refers_to", "bytes", "digest")


def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, f"llm-warc-{uuid.uuid4().hex}")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to")


ORACLE = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS target FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id < target THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id < target THEN target END AS refers_to
FROM g
"""
