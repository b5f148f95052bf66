r"""Operator 2, substring deduplication by sliding sentence spans.

A text's words (white space apart, A-Z in lower case) are grouped into sentences: one ends
after a word that ends in ``.``, ``!`` or ``?`` (and closing quotes or brackets) and before a
line break. A sentence of more than ``LONGEST`` words is cut further where its own words say
so: after a word of a multiple of ``CUT_LENGTH`` bytes, and after one of the ``NEAR`` words
before it again; so a passage set inside a long sentence has whole parts of its own. From
every sentence (or part) on, the shortest run of consecutive ones with ``MIN_WORDS`` words or
more is a span, and the last of these again up to the text's end; a span is hashed to 128 bits
by its words.

Hashes are counted over all documents with partial sums, and the repeated ones are joined
back to their spans: all occurrences but the first (smallest doc_id, then text hash, then
place) mark their sentences, and marked sentences are removed.

A very frequent span is one row in the aggregate, which is partial before the shuffle, and in
the join its occurrences are rows of a plain equi-join that can be split; nothing is gathered
but a document's own marks. Texts cross one shuffle, compressed.

Edge cases: null or empty texts have no sentences; texts of fewer than ``MIN_WORDS`` words are
kept; rows that repeat id and text are one document and give equal rows; a null doc_id
comes first; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm._common import SPACE, mix64, read_table, rows, stage_table

MIN_WORDS = 38
LONGEST = 24
CUT_LENGTH = 8
NEAR = 1
SLICE = 1 << 22

_SPACES = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_CLOSING = b"\"')]}"
_STOPS, _CLOSE = (np.isin(np.arange(256), list(chars)) for chars in (b".!?", _CLOSING))
_CYCLE = 4096  # weights repeat; the word's length and the place's block enter the hash
_WEIGHTS = [np.cumprod(np.full(_CYCLE, odd, np.uint64)) for odd in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]


def _runs(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of ragged runs laid end to end: each place, its place within its run, first places."""
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    return np.repeat(starts, lengths) + within, within, first


def sentences(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Byte offsets where words start, numbers of the words that open a sentence or part, their
    word counts, and two 64-bit hashes of each word."""
    data = text.lower()
    raw = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(np.r_[False, ~_SPACES[raw], False]))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, starts, starts, [np.empty(0, np.uint64)] * 2
    length = ends - starts
    hashes = [np.empty(len(starts), np.uint64) for _ in _WEIGHTS]
    step = np.unique(np.searchsorted(ends, np.arange(SLICE, len(data) + SLICE, SLICE)).clip(1, len(starts)))
    for a, b in zip([0, *step[:-1].tolist()], step.tolist()):
        place, within, first = _runs(starts[a:b], length[a:b])
        value = raw[place].astype(np.uint64) + np.uint64(1) + ((within // _CYCLE).astype(np.uint64) << np.uint64(9))
        for h, weight in zip(hashes, _WEIGHTS):
            h[a:b] = mix64(np.add.reduceat(value * weight[within % _CYCLE], first) + length[a:b].astype(np.uint64))
    # the last byte that does not close a quote or bracket
    last = ends - 1
    for _ in range(4):
        last = np.where((last > starts) & _CLOSE[raw[last]], last - 1, last)
    broken = np.cumsum(raw == 10)
    stop = _STOPS[raw[last]] | np.r_[broken[starts[1:]] > broken[ends[:-1] - 1], True]
    stop[-1] = True
    sentence = np.cumsum(stop) - stop
    long = np.bincount(sentence)[sentence] > LONGEST
    again = np.zeros(len(starts), bool)
    for back in range(1, min(NEAR, len(starts) - 1) + 1):
        again[back:] |= (hashes[0][back:] == hashes[0][:-back]) & (hashes[1][back:] == hashes[1][:-back])
    stop |= long & ((length % CUT_LENGTH == 0) | again)
    opens = np.flatnonzero(np.r_[True, stop[:-1]])
    return starts, opens, np.diff(np.r_[opens, len(starts)]), hashes


def text_spans(text: bytes, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every span of a text: its first sentence, how many it has, and its two hashes."""
    _, opens, size, hashes = sentences(text)
    upto = np.r_[0, np.cumsum(size)]
    until = np.searchsorted(upto, upto[:-1] + min_words)
    at = np.flatnonzero(until < len(upto))
    until = until[at]
    if len(at) and until[-1] < len(size):
        at, until = np.r_[at, at[-1]], np.r_[until, len(size)]
    words = upto[until] - upto[at]
    told: list[list[np.ndarray]] = [[], []]
    for a in range(0, len(at), 1 << 16):
        part = slice(a, a + (1 << 16))
        place, within, first = _runs(opens[at[part]], words[part])
        for out, h, weight in zip(told, hashes, _WEIGHTS):
            out.append(mix64(np.add.reduceat(h[place] * weight[within % _CYCLE], first) + words[part].astype(np.uint64)))
    h1, h2 = (np.concatenate([np.empty(0, np.uint64), *x]) for x in told)
    return at, until - at, h1, h2


_SPANS = "doc_id long, text_hash long, at int, n int, h1 long, h2 long"
_TEXT = "doc_id long, text_hash long, packed binary"


def _slim(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))


def _find(min_words: int):
    names = [c.split()[0] for c in _SPANS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                found: list[list] = [[] for _ in names]
                for doc_id, text_hash, text in rows(batch.slice(k, 64), "doc_id", "text_hash", "text"):
                    at, n, h1, h2 = text_spans(text, min_words)
                    if len(at):
                        ids = pa.nulls(len(at), pa.int64()) if doc_id is None else pa.array(np.full(len(at), doc_id, np.int64))
                        for column, values in zip(found, (ids, pa.array(np.full(len(at), text_hash, np.int64)), pa.array(at.astype(np.int32)),
                                                          pa.array(n.astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)))):
                            column.append(values)
                if found[0]:
                    yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in found], names=names)
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        packed = [pack(t) for _, _, t in rows(batch, "doc_id", "text_hash", "text")]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "text_hash", "packed"])


_KEPT = "doc_id long, n_sentences long, n_removed long, n_spans long, kept_text string"


def cut_out(text: bytes, marks: list[tuple[int, int]]) -> tuple[int, int, int, bytes]:
    """Sentences of a text, those under a mark (first sentence, count), the maximal runs of them,
    and the text without them."""
    starts, opens, _, _ = sentences(text)
    gone = np.zeros(len(opens) + 1, np.int64)
    for at, n in marks:
        gone[at] += 1
        gone[at + n] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
    if not len(edges):
        return len(opens), 0, 0, text
    byte = np.r_[starts[opens], len(text)]
    out, at = [], 0
    for a, b in zip(byte[edges[::2]].tolist(), byte[edges[1::2]].tolist()):
        out.append(text[at:a])
        at = b
    return len(opens), int(gone.sum()), len(edges) // 2, b"".join([*out, text[at:]])


def _cut(as_text: bool):
    last = pa.field("kept_text" if as_text else "kept_sha256", pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                out = []
                for doc_id, packed, marks in rows(batch.slice(k, 256), "doc_id", "packed", "marks"):
                    *counts, kept = cut_out(unpack(packed), [(m["at"], m["n"]) for m in marks or ()])
                    out.append((doc_id, *counts, kept.decode("utf-8", "replace") if as_text else hashlib.sha256(kept).hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [last.type])],
                                                 names=["doc_id", "n_sentences", "n_removed", "n_spans", last.name])
    return run


def marked(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, packed`` (the compressed text) and ``marks``, its spans that occur before."""
    slim = _slim(docs)
    found = stage_table(slim.mapInArrow(_find(min_words), _SPANS), "spans")
    place = F.struct("doc_id", "text_hash", "at")
    # counts alone cross the first shuffle; the repeated spans, few, then find their first place
    # (tables of their own, so that a frequent span is a skewed join key that Spark can split)
    often = stage_table(found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "spans-often")
    repeated = stage_table(found.join(often, ["h1", "h2"], "left_semi"), "spans-repeated")
    first = stage_table(repeated.groupBy("h1", "h2").agg(F.min(place).alias("first")), "spans-first")
    later = repeated.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    marks = later.groupBy(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash")) \
        .agg(F.collect_set(F.struct("at", "n")).alias("marks"))
    texts = slim.mapInArrow(_pack, _TEXT)
    return texts.join(marks, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash")), "left") \
        .select("doc_id", "packed", "marks")


def remove_repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_sentences, n_removed, n_spans`` (maximal removed
    runs) and ``kept_text``."""
    return marked(docs, min_words).mapInArrow(_cut(True), _KEPT)


def op2_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(read_table(spark, sf_dir, "documents")).mapInArrow(_cut(False), _KEPT.replace("kept_text", "kept_sha256"))


_STOP_SQL = "[.!?][" + re.escape(_CLOSING.decode()).replace("'", "''") + "]{0,4}$"

ORACLE = rf"""
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS k, coalesce(text, '') AS t FROM documents),
x AS (SELECT doc_id, k, t, regexp_extract_all(t, '[^{SPACE}]+[{SPACE}]*') AS toks FROM d),
a AS (SELECT k, unnest(toks) AS tok, unnest(range(1, len(toks) + 1)) AS i FROM x),
w AS (SELECT *, translate(regexp_extract(tok, '^[^{SPACE}]+'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM a),
s AS (SELECT *, regexp_matches(w, '{_STOP_SQL}') OR contains(tok, chr(10)) AS stop FROM w),
n AS (SELECT *, coalesce(sum(stop::INT) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence FROM s),
l AS (SELECT *, count(*) OVER (PARTITION BY k, sentence) > {LONGEST} AS long,
      list_contains(list(w) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN {NEAR} PRECEDING AND 1 PRECEDING), w) AS again FROM n),
c AS (SELECT *, stop OR (long AND (strlen(w) % {CUT_LENGTH} = 0 OR coalesce(again, false))) AS cut FROM l),
u AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS u FROM c),
g AS (SELECT k, u, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS words, string_agg(tok, '' ORDER BY i) AS piece FROM u GROUP BY k, u),
h AS (SELECT *, sum(n) OVER (PARTITION BY k ORDER BY u) AS upto FROM g),
p AS (SELECT f.k, f.u, min(e.u) AS last FROM h f JOIN h e ON e.k = f.k AND e.u BETWEEN f.u AND f.u + {MIN_WORDS - 1}
      AND e.upto - f.upto + f.n >= {MIN_WORDS} GROUP BY f.k, f.u),
b AS (SELECT * FROM p UNION SELECT p.k, p.u, z.n FROM p JOIN (SELECT k, max(u) AS n FROM h GROUP BY k) z ON z.k = p.k
      WHERE p.u = (SELECT max(y.u) FROM p y WHERE y.k = p.k)),
r AS (SELECT p.k, p.u, p.last, string_agg(h.words, ' ' ORDER BY h.u) AS span FROM b p JOIN h ON h.k = p.k AND h.u BETWEEN p.u AND p.last
      GROUP BY p.k, p.u, p.last),
q AS (SELECT *, row_number() OVER (PARTITION BY span ORDER BY k, u) AS nth FROM r),
gone AS (SELECT DISTINCT k, unnest(range(u::BIGINT, last::BIGINT + 1)) AS u FROM q WHERE nth > 1),
m AS (SELECT k, count(*) AS n, count(*) FILTER (new) AS runs FROM (
        SELECT k, u - coalesce(lag(u) OVER (PARTITION BY k ORDER BY u), -9) > 1 AS new FROM gone) GROUP BY k),
kept AS (SELECT h.k, string_agg(h.piece, '' ORDER BY h.u) AS t FROM h LEFT JOIN gone ON gone.k = h.k AND gone.u = h.u
         WHERE gone.u IS NULL GROUP BY h.k),
z AS (SELECT k, count(*) AS n FROM h GROUP BY k)
SELECT x.doc_id, coalesce(z.n, 0)::BIGINT AS n_sentences, coalesce(m.n, 0)::BIGINT AS n_removed, coalesce(m.runs, 0)::BIGINT AS n_spans,
       sha256(regexp_extract(x.t, '^[{SPACE}]*') || coalesce(kept.t, '')) AS kept_sha256
FROM x LEFT JOIN z USING (k) LEFT JOIN m USING (k) LEFT JOIN kept USING (k)
"""
