r"""Operator 10, benchmark decontamination with an Aho-Corasick automaton.

Texts are normalised to words (A-Z in lower case; a word is a run of ASCII letters, digits
and non-ASCII characters) joined by single spaces. Every window of 10 consecutive words of
a benchmark text is a pattern (a shorter text is one pattern). One automaton holds them
all; each document is scanned once, and the end of a match is mapped back to word numbers
by the positions of the spaces (``word_offsets`` maps those to the original text).

The automaton is built from at most ``MAX_ITEM_BYTES`` of benchmark text, the bound of what
is broadcast. A larger benchmark is dealt by item into as many parts as needed, each within
the bound (an item's windows stay together). Each part is one scan of the documents that gives
rows for those it hits alone, keyed by id and hashes of the text, without texts: a bit a word
and the items. Texts are read once a part and never written; ``drop_contaminated`` shuffles
them once if there are several parts, ``scan_documents`` never.

Edge cases: null or empty texts have no words and are not hit; items without words match
nothing; equal items both count; an item without an id counts and is written as an empty
string; repeated documents give a row each; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm._common import read_table, rows, text_bytes

WINDOW = 10
MAX_ITEM_BYTES = 256 * 1024

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(0x20 if b in _SEPARATORS else b for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_TABLE).split()  # bytes.lower() changes A-Z only


def word_offsets(text: bytes) -> list[tuple[int, int]]:
    """Code-point range of each word in the original text."""
    body = np.frombuffer(b" " + text.lower().translate(_TABLE) + b" ", np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(body.astype(np.int8)))
    at = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return list(zip(at[edge[::2]].tolist(), at[edge[1::2]].tolist()))


def patterns_of(items: list[tuple[int | None, bytes]], window: int = WINDOW) -> dict[str, tuple[int, list[str]]]:
    """Pattern (one character per byte, a space before and after) to its number of words
    and the items that hold it."""
    owners: dict[bytes, set[str]] = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        for at in range(max(1, len(words) - window + 1) if words else 0):
            owners[b" ".join(words[at:at + window])].add("" if item is None else str(item))
    return {f" {k.decode('latin-1')} ": (k.count(b" ") + 1, sorted(v)) for k, v in owners.items()}


_BUILT: dict[str, object] = {}


def automaton(shared) -> object:
    """The automaton of a broadcast item list, built once per worker process."""
    if shared.id not in _BUILT:
        import ahocorasick
        _BUILT.clear()
        made = ahocorasick.Automaton()
        for pattern, value in patterns_of(shared.value).items():
            made.add_word(pattern, value)
        if len(made):
            made.make_automaton()
        _BUILT[shared.id] = made
    return _BUILT[shared.id]


class Shared:
    """A broadcast with the id that tells workers apart which automaton they hold."""

    def __init__(self, spark: SparkSession, items: list):
        self.id, self._sent = uuid.uuid4().hex, spark.sparkContext.broadcast(items)

    @property
    def value(self):
        return self._sent.value


def find_hits(made, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
    """Which words are hit, and the items with an occurring window."""
    hit, items = np.zeros(len(words), bool), set()
    if words and len(made):
        line = b" " + b" ".join(words) + b" "
        gaps = None
        for end, (length, owners) in made.iter(line.decode("latin-1")):
            if gaps is None:
                gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
            last = int(np.searchsorted(gaps, end))
            hit[last - length:last] = True
            items.update(owners)
    return hit, items


def item_parts(benchmark: DataFrame, bound: int = MAX_ITEM_BYTES) -> list[Shared]:
    """The benchmark in broadcast parts of about ``bound`` bytes, dealt by item."""
    spark = benchmark.sparkSession
    items = text_bytes(benchmark, "item_id").dropDuplicates()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // bound))
    part = F.pmod(F.xxhash64("id"), F.lit(n))
    return [Shared(spark, [(r["id"], bytes(r["text"])) for r in items.where(part == k).collect()])
            for k in range(n)]


def scan_documents(docs: DataFrame, benchmark: DataFrame, bound: int = MAX_ITEM_BYTES) -> DataFrame:
    """One row per document with the words hit and the items found."""
    parts = item_parts(benchmark, bound)
    slim = text_bytes(docs)
    if len(parts) == 1:
        return slim.mapInArrow(_reporter(parts[0]), _REPORT)
    keyed = slim.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    first = keyed.mapInArrow(_marker(parts[0], True), _MARKS).select("id", "h1", "h2", "n_words", F.struct("mask", "items").alias("own"))
    more = None
    for k, shared in enumerate(parts[1:]):
        part = keyed.mapInArrow(_marker(shared, False), _MARKS).withColumn("part", F.lit(k))
        more = part if more is None else more.union(part)
    once = more.groupBy("id", "h1", "h2", "part").agg(F.first("mask").alias("mask"), F.first("items").alias("items"))
    more = once.groupBy("id", "h1", "h2").agg(F.collect_list(F.struct("mask", "items")).alias("more"))
    same = first["id"].eqNullSafe(more["id"]) & (first["h1"] == more["h1"]) & (first["h2"] == more["h2"])
    found = first.join(more, same, "left").select(
        first["id"].alias("id"), "n_words", F.concat(F.array("own"), F.coalesce("more", F.array())).alias("found"))
    return found.mapInArrow(_combine, _REPORT)


_REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_MARKS = "id long, h1 long, h2 long, n_words long, mask binary, items array<string>"


def _marker(shared: Shared, every: bool):
    """Words hit and items found by one part; of documents that it does not hit only if ``every``."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = automaton(shared)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()))
        for batch in batches:
            out = []
            for key, text, h1, h2 in rows(batch, "id", "text", "h1", "h2"):
                hit, items = find_hits(made, words_of(text))
                if every or items:
                    out.append((key, h1, h2, len(hit), np.packbits(hit).tobytes(), sorted(items)))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["id", "h1", "h2", "n_words", "mask", "items"])
    return mark


def _reported(out: list[tuple]) -> pa.RecordBatch:
    """Rows ``id, words hit, items`` as the report's."""
    told = [(k, len(h), int(h.sum()), len(i), hashlib.sha256(",".join(sorted(i)).encode()).hexdigest(), bool(h.any()))
            for k, h, i in out]
    columns = list(zip(*told)) or [()] * 6
    types = [pa.int64()] * 4 + [pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def _reporter(shared: Shared):
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = automaton(shared)
        for batch in batches:
            yield _reported([(k, *find_hits(made, words_of(t))) for k, t in rows(batch, "id", "text")])
    return report


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, n_words, found in rows(batch, "id", "n_words", "found"):
            hit, items = np.zeros(n_words, bool), set()
            for one in found:
                hit |= np.unpackbits(np.frombuffer(one["mask"], np.uint8), count=n_words).astype(bool)
                items.update(one["items"])
            out.append((key, hit, items))
        yield _reported(out)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      bound: int = MAX_ITEM_BYTES) -> DataFrame:
    """The documents without any benchmark window, with exactly the columns they came with."""
    def keeper(shared: Shared):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = automaton(shared)
            for batch in batches:
                clean = [not find_hits(made, words_of((t or "").encode()))[0].any()
                         for t, in rows(batch, text_col)]
                yield batch.filter(pa.array(clean, pa.bool_()))
        return keep

    parts = item_parts(benchmark, bound)
    if len(parts) == 1:
        return docs.mapInArrow(keeper(parts[0]), docs.schema)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.lit(0).cast("long").alias("id"), text.cast("binary").alias("text")).withColumns(
        {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    found = reduce(DataFrame.union, [keyed.mapInArrow(_marker(p, False), _MARKS).select("h1", "h2") for p in parts]).distinct()
    own = text.cast("binary")
    return docs.join(found, (F.xxhash64(own) == found["h1"]) & (F.xxhash64(F.lit(1), own) == found["h2"]), "left_anti")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) AS p
        FROM i WHERE len(w) > 0)),
dw AS (
  SELECT k, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT k, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT k, n, p, item_id FROM dw JOIN iw USING (n, g)),
pos AS (SELECT k, count(*) AS n_hit FROM (SELECT DISTINCT k, unnest(range(p, p + n)) AS at FROM hit) GROUP BY k),
its AS (SELECT k, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (k) LEFT JOIN its USING (k)
"""
