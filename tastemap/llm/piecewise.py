"""Operator 11, document fingerprints by context-triggered piecewise hashing.

The block size is the least power of two (4 or more) of which the UTF-8 text holds at most 64.
A hash of the last ``WINDOW`` bytes is taken at every byte; a chunk ends where its low bits are
zero, one time in a block size on average, but not before an eighth of the block size, and
after four block sizes at the latest, so that a repeated phrase gives neither thousands of
chunks nor a single one. Each chunk, the tail included, is hashed to 12 bits, written as two
characters. A fingerprint is ``block size:signature:signature at twice the block size``.

Two fingerprints are compared at the block sizes that both carry: 1 - edit distance / longer
length, counted in chunks, the larger value if both sizes agree; 0 if no size is shared, 1
for equal fingerprints.

``fingerprint_pairs`` gives each document and its successor in ascending order of id. The ids
are dealt into ranges (bounds are quantiles of the ids: one number a range reaches the
driver); texts cross one shuffle, compressed, and are sorted on disk within a range, where
each row meets the next one. Only the first and the last row of a range go on: one join of
one row a range links them, the last range to the first.

Edge cases: null text is the empty text, whose fingerprint is ``4::``; null ids come first;
rows with equal ids are ordered by the sha256 of their text, so repeated rows follow each
other; the only row of a table is its own successor; an empty table gives an empty result;
bytes that are not UTF-8 are read as U+FFFD; further columns are not read. Texts are read in
slices of ``SLICE`` bytes, so the working arrays do not grow with a text.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastemap.llm._common import mix64, read_table, rows, stage_table, text_bytes

WINDOW = 8
LEAST_LEVEL = 2
BLOCKS = 64
SLICE = 1 << 18
#: Ids are dealt into as many ranges as the session has shuffle partitions, and into more so
#: that a range holds about so many rows.
ROWS_PER_RANGE = 1_000_000

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS = np.cumprod(np.r_[np.uint64(1), np.full(SLICE, _BASE, np.uint64)])
_INVERSE = np.cumprod(np.r_[np.uint64(1), np.full(SLICE - 1, pow(_BASE, -1, 1 << 64), np.uint64)])
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_CHUNK = [a + b for a in _DIGITS for b in _DIGITS]


def _trigger(windows: np.ndarray) -> np.ndarray:
    """40-bit hash of each window, a little-endian 64-bit number."""
    return mix64(windows * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(24)


class _Cutter:
    """Chunk characters at one block size, fed with the triggers of a text slice by slice."""

    def __init__(self, level: int):
        self.mask = np.uint64((1 << level) - 1)
        self.least, self.most = max(1, (1 << level) // 8), 4 << level
        self.last, self.cuts, self.sums = 0, [0], [0]

    def feed(self, start: int, m: int, at: np.ndarray, trigger: np.ndarray, prefix: np.ndarray, total: int, scale: int) -> None:
        ends = (at[trigger & self.mask == 0] + (start + 1)).tolist()
        found = []
        while True:
            k = bisect.bisect_left(ends, self.last + self.least)
            end = min(ends[k] if k < len(ends) else start + m + 1, self.last + self.most)
            if end > start + m:
                break
            found.append(end)
            self.last = end
        self.cuts += found
        self.sums += (np.uint64(total) + prefix[np.array(found, np.int64) - start - 1] * np.uint64(scale)).tolist()

    def signature(self, n: int, total: int, shift: list[int]) -> str:
        if self.last < n:
            self.cuts.append(n)
            self.sums.append(total)
        cuts, sums = np.array(self.cuts), np.array(self.sums, np.uint64)
        inverse = _INVERSE[cuts[:-1] % SLICE] * np.array(shift, np.uint64)[cuts[:-1] // SLICE]
        hashed = mix64((sums[1:] - sums[:-1]) * inverse + np.diff(cuts).astype(np.uint64))
        return "".join(_CHUNK[x] for x in (hashed >> np.uint64(52)).tolist())


def fingerprint(data: bytes) -> str:
    """``block size:signature:signature at twice the block size`` of a text's bytes."""
    n = len(data)
    level = max(LEAST_LEVEL, (n // BLOCKS).bit_length())
    if not n:
        return f"{1 << level}::"
    cutters = _Cutter(level), _Cutter(level + 1)
    total, scale, shift = 0, 1, []  # prefix sum so far, base**start, base**-start of each slice
    for start in range(0, n, SLICE):
        before = data[max(0, start - WINDOW + 1):start].rjust(WINDOW - 1, b"\0")
        part = before + data[start:start + SLICE]
        m = len(part) - WINDOW + 1
        trigger = _trigger(np.ndarray((m,), "<u8", part, strides=(1,)))
        prefix = np.cumsum((np.frombuffer(part, np.uint8, m, WINDOW - 1).astype(np.uint64) + np.uint64(1)) * _POWERS[:m])
        at = np.flatnonzero(trigger & cutters[0].mask == 0)
        for cutter in cutters:
            cutter.feed(start, m, at, trigger[at], prefix, total, scale)
        total = (total + int(prefix[-1]) * scale) & _MASK
        shift.append(pow(scale, -1, 1 << 64))
        scale = scale * int(_POWERS[m]) & _MASK
    return ":".join([str(1 << level), *(c.signature(n, total, shift) for c in cutters)])


def edit_distance(a: list[str], b: list[str]) -> int:
    """Insertions, deletions and substitutions between two lists, a bit per entry of ``a``."""
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b or not set(a) & set(b):
        return max(len(a), len(b))
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = full, 0, len(a)  # where a column's cell is one more or one less than the cell above
    for y in b:
        same = places.get(y, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        distance += bool(right_up & top) - bool(right_down & top)
        right_up = (right_up << 1 | 1) & full
        right_down = right_down << 1 & full
        up = right_down | ~(diagonal | right_up) & full
        down = right_up & diagonal
    return distance


def likeness(one: str, other: str) -> float:
    """How alike two fingerprints are, 0 to 1."""
    if one == other:
        return 1.0
    parts = []
    for fp in (one, other):
        size, first, second = fp.split(":")
        parts.append({int(size): first, 2 * int(size): second})
    best = 0.0
    for size in parts[0].keys() & parts[1].keys():
        a, b = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in (parts[0][size], parts[1][size]))
        if a and b:
            best = max(best, 1 - edit_distance(a, b) / max(len(a), len(b)))
    return best


_DEALT = "bucket int, id long, sha string, fp string, packed binary"
_PAIRED = ("bucket int, kind int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double, packed binary")
_RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_DONE, _FIRST, _LAST = 0, 1, 2


def _batches(found: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    kept: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), types)], names=names)

    for row in found:
        kept.append(row)
        if len(kept) == 256:
            yield made()
            kept.clear()
    if kept:
        yield made()


def _deal(bounds: list[float]):
    names, types = ["bucket", "id", "sha", "fp", "packed"], [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        edges = np.array(bounds)

        def told():
            for batch in batches:
                for i, text in rows(batch, "id", "text"):
                    bucket = 0 if i is None else int(np.searchsorted(edges, float(i), "right"))
                    yield bucket, i, hashlib.sha256(text).hexdigest(), fingerprint(text), pack(text)
        yield from _batches(told(), names, types)
    return run


def _compared(i: int | None, text: str, fp: str, next_text: str, next_fp: str) -> tuple:
    cut = len(text) // 4
    edited = (text[:len(text) - cut] + next_text[:cut]).encode()
    edited_fp = fingerprint(edited)
    return (i, len(text), hashlib.sha256(edited).hexdigest(), fp, edited_fp, likeness(fp, edited_fp), likeness(fp, next_fp))


_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(),
          pa.binary()]


def _pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole buckets: each row with its successor; first and last rows go on."""
    unpack = zstandard.ZstdDecompressor().decompress

    def told():
        last = None  # bucket, id, fingerprint, text, packed
        edge = lambda kind, r: (r[0], kind, r[1], None, None, r[2], None, None, None, r[4])
        for batch in batches:
            for bucket, i, fp, packed in rows(batch, "bucket", "id", "fp", "packed"):
                row = (bucket, i, fp, unpack(packed).decode("utf-8", "replace"), packed)
                if last is not None and last[0] == bucket:
                    yield bucket, _DONE, *_compared(last[1], last[3], last[2], row[3], fp), None
                else:
                    if last is not None:
                        yield edge(_LAST, last)
                    yield edge(_FIRST, row)
                last = row
        if last is not None:
            yield edge(_LAST, last)
    yield from _batches(told(), [c.split()[0] for c in _PAIRED.split(", ")], _TYPES)


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    text = lambda b: unpack(b).decode("utf-8", "replace")

    def told():
        for batch in batches:
            for i, fp, packed, next_fp, next_packed in rows(batch, "doc_id", "fp", "packed", "next_fp", "next_packed"):
                yield _compared(i, text(packed), fp, text(next_packed), next_fp)
    yield from _batches(told(), _RESULT, _TYPES[2:-1])


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. The edited text is the document with its last quarter replaced
    by the start of the next document."""
    spark = docs.sparkSession
    slim = text_bytes(docs)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), slim.count() // ROWS_PER_RANGE)
    shares = [k / ranges for k in range(1, ranges)]
    bounds = slim.where("id is not null").approxQuantile("id", shares, 0.25 / ranges) if shares else []
    dealt = slim.mapInArrow(_deal(sorted(set(bounds))), _DEALT)
    paired = stage_table(dealt.repartition("bucket").sortWithinPartitions("bucket", "id", "sha")
                         .select("bucket", "id", "fp", "packed").mapInArrow(_pair, _PAIRED), "piecewise")
    first = paired.where(F.col("kind") == _FIRST).select(
        F.col("bucket").alias("next_bucket"), F.col("fingerprint").alias("next_fp"), F.col("packed").alias("next_packed"))
    # the bucket that follows each one: a row per range, numbers only
    order, every = Window.orderBy("bucket"), Window.partitionBy()
    follows = paired.where(F.col("kind") == _FIRST).select("bucket").select(
        "bucket", F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(every)).alias("next_bucket"))
    last = paired.where(F.col("kind") == _LAST).select("bucket", "doc_id", F.col("fingerprint").alias("fp"), "packed")
    links = last.join(follows, "bucket").join(first, "next_bucket") \
        .select("doc_id", "fp", "packed", "next_fp", "next_packed") \
        .mapInArrow(_link, ", ".join(c for c in _PAIRED.split(", ") if c.split()[0] in _RESULT))
    return paired.where(F.col("kind") == _DONE).select(*_RESULT).unionByName(links)


def op11_piecewise_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(read_table(spark, sf_dir, "documents"))
