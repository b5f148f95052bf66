r"""Operator 5, suffix-array deduplication of byte strings across all documents.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else (same
document included) is removed. Strings are compared by external induced suffix sorting
(``suffix_sort``); the windows that can match are first dealt out by content, so that each
shard is sorted alone and windows that occur once are never sorted:

1. Each window's anchor is the leftmost smallest hash of the 16-grams in it. Neighbouring
   windows with one anchor form a piece; equal windows have equal anchors at equal places.
   An anchor that occurs once ends the matter for its windows.
2. A piece that occurs twice is repeated as a whole. Different pieces of one anchor may share
   windows; those are told apart further by the 351 bytes common to all windows of a class
   (places of the anchor ``STEP`` bytes apart). Only classes met in several pieces remain.
3. The remaining class texts, one for each distinct piece, go to shards by anchor and class.
   Equal class texts of several pieces are repeated whole and enter once. The 351 bytes that
   all windows of a text share are written as one code of ``DIGITS`` symbols for each distinct
   string of them (told by a 128-bit hash), so a text is at most 98 bytes and a code, and a
   window 49 bytes and a code. A task writes its shard to disk and sorts it; what shares
   such a window with a neighbour in suffix order is repeated.
4. A class that would fill a shard, or holds over a ``SALTS``-th of all rows (and over
   ``CLASS_PIECES``), is no task's work: its windows, the finest classes, are counted by
   a 128-bit hash.

All counting is by group-by with partial sums; a passage in very many documents is one
piece, only the windows over its edges differ. Keys that hold over a ``SALTS``-th of all rows
(there are fewer than ``SALTS``) are salted in the joins. Texts are read three times and
shuffled twice, for the class texts and for the result.

Edge cases: null and empty texts have no bytes and lose none; repeated rows repeat each
other's strings, so rows of LENGTH bytes or more go whole; texts under LENGTH bytes are kept;
an empty table gives an empty result; a null doc_id is a value like others; further columns
are not read.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm._common import drop_table, mix64, read_table, rows, stage_table, text_bytes
from tastemap.llm.suffix_sort import repeated

LENGTH = 400
GRAM = 16
STEP = 50
COMMON = LENGTH - STEP + 1  # bytes that all windows of a class hold
DIGITS, BASE = 3, 1024  # of the code that stands for them: symbols above those of bytes
CODED = LENGTH - COMMON + DIGITS
SHARD_SYMBOLS = 1 << 22
CLASS_PIECES = 1024  # classes of so many pieces are always sorted
SALTS = 64
SLICE = 1 << 22  # window starts handled at once; places fit the low 24 bits
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 16-byte and all 256-byte strings, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    times, width, short = 0x9E3779B97F4A7C15, 1, h
    while width < 256:
        h = h[:-width] * np.uint64(times) + h[width:]
        times, width = times * times & (1 << 64) - 1, 2 * width
        if width == GRAM:
            short = h
    return mix64(short), h


def window_anchors(grams: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each window start the place of its leftmost smallest gram."""
    count = length - GRAM + 1
    low = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    total, width = len(grams) - count + 1, 1
    while 2 * width <= count:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = count - width
    return (np.minimum(low[:total], low[rest:rest + total]) & np.uint64(0xFFFFFF)).astype(np.int64)


def pieces_of(text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """Per slice of window starts: anchor hashes, piece hashes, first window, windows, place of
    the anchor from the first window, number of class keys, and those keys in a row."""
    for at in range(0, len(text) - LENGTH + 1, SLICE):
        part = text[at:at + SLICE + LENGTH - 1]
        grams, blocks = gram_hashes(np.frombuffer(part, np.uint8))
        place = window_anchors(grams)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        anchor = place[first]
        piece = [xxhash.xxh3_64_intdigest(part[a:b + LENGTH]) for a, b in zip(first.tolist(), last.tolist())]
        low, high = (anchor - last) // STEP, (anchor - first) // STEP
        count = high - low + 1
        cls = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        begin = np.repeat(anchor, count) - STEP * cls  # the class's windows all hold [begin, begin + 351)
        keys = mix64(blocks[begin] * _FOLD + blocks[begin + LENGTH - STEP + 1 - 256] + cls.astype(np.uint64))
        yield (grams[anchor].view(np.int64), np.array(piece, np.uint64).view(np.int64), first + at,
               last - first + 1, anchor - first, count, (keys >> np.uint64(32)).astype(np.uint32).view(np.int32))


_PIECES = "doc_id long, text_hash long, anchor long, piece long, first long, windows int, place int, keys array<int>"


def cut_pieces(docs: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text_hash, text in rows(batch, "id", "text_hash", "text"):
                for anchor, piece, first, windows, place, count, keys in pieces_of(text):
                    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_id] * len(anchor), pa.int64()), pa.array([text_hash] * len(anchor), pa.int64()),
                        pa.array(anchor), pa.array(piece), pa.array(first, pa.int64()),
                        pa.array(windows.astype(np.int32)), pa.array(place.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys))],
                        names=["doc_id", "text_hash", "anchor", "piece", "first", "windows", "place", "keys"])

    return docs.mapInArrow(_batched(cut), _PIECES)


def _batched(cut):
    """Join the small batches that single documents give."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in cut(batches):
            held.append(batch)
            size += batch.num_rows
            if size >= 20_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return joined


def class_texts(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """Texts of the classes in ``shared`` (``doc_id, text_hash, anchor, piece, key, begin, skip,
    windows, left, split``): the ``windows + LENGTH - 1`` bytes from ``begin`` without the COMMON ones from
    their ``left``-th on, and the hash of those."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, parts in rows(batch, "text", "parts"):
                middle = [p["begin"] + p["left"] for p in parts]
                body = [text[p["begin"]:m] + text[m + COMMON:p["begin"] + p["windows"] + LENGTH - 1]
                        for p, m in zip(parts, middle)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[n] for p in parts], t) for n, t in (
                        ("anchor", pa.int64()), ("key", pa.int32()), ("piece", pa.int64()), ("skip", pa.int64()),
                        ("windows", pa.int64()), ("left", pa.int64()), ("split", pa.bool_()))]
                    + [pa.array([xxhash.xxh3_128_digest(text[m:m + COMMON]) for m in middle], pa.binary()),
                       pa.array(body, pa.binary())],
                    names=["anchor", "key", "piece", "skip", "windows", "left", "split", "common", "body"])

    parts = shared.groupBy("doc_id", "text_hash").agg(F.collect_list(
        F.struct("anchor", "key", "piece", "begin", "skip", "windows", "left", "split")).alias("parts"))
    joined = docs.join(parts, docs["id"].eqNullSafe(parts["doc_id"]) & (docs["text_hash"] == parts["text_hash"]))
    return joined.select("text", "parts").mapInArrow(
        _batched(cut), "anchor long, key int, piece long, skip long, windows long, left long, split boolean, "
        "common binary, body binary")


def coded(left: int, code: int, body: bytes) -> np.ndarray:
    """Symbols of a class text: bytes from 2, the code of its common part, a separator."""
    out = np.empty(len(body) + DIGITS + 1, np.int16)
    data = np.frombuffer(body, np.uint8).astype(np.int16) + 2
    out[:left], out[left + DIGITS:-1] = data[:left], data[left:]
    out[left:left + DIGITS] = [258 + code // BASE ** k % BASE for k in range(DIGITS)]
    out[-1] = 1
    return out


def sorted_repeats(texts: DataFrame, shards: int) -> DataFrame:
    """``anchor, piece, a, b``: repeated windows a <= w < b of each piece, by suffix order."""
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners: list[list[tuple]] = []  # of each distinct text of a class: anchor, piece, skip, windows
        begins, written, at = [], [], 0
        last, seen, codes, n_codes, waiting = None, {}, {}, 0, None
        with tempfile.TemporaryDirectory() as folder:
            with open(f"{folder}/text", "wb") as out:
                def write(number: int, symbols: np.ndarray) -> int:
                    symbols.tofile(out)
                    begins.append(at)
                    written.append(number)
                    return at + len(symbols)

                for batch in batches:
                    for anchor, key, piece, skip, windows, left, common, body in rows(
                            batch, "anchor", "key", "piece", "skip", "windows", "left", "common", "body"):
                        if (anchor, key) != last:
                            last, seen, codes, waiting = (anchor, key), {}, {}, None
                        told = left, common, body
                        if told in seen:
                            owners[seen[told]].append((anchor, piece, skip, windows))
                            continue
                        number = seen[told] = len(owners)
                        owners.append([(anchor, piece, skip, windows)])
                        if common not in codes:
                            codes[common] = n_codes
                            n_codes += 1
                        symbols = coded(left, codes[common], body)
                        if len(seen) == 1:  # a class with one text only has nothing to sort
                            waiting = number, symbols
                            continue
                        if waiting:
                            at = write(*waiting)
                            waiting = None
                        at = write(number, symbols)
                np.zeros(1, np.int16).tofile(out)
            hits = np.sort(repeated(np.memmap(f"{folder}/text", np.int16, "r"), CODED, folder)) if begins \
                else np.empty(0, np.int64)
        found = [(n, p, s, s + w) for same in owners if len(same) > 1 for n, p, s, w in same]
        if len(hits):
            owner = np.searchsorted(begins, hits, "right") - 1
            place = hits - np.array(begins)[owner]
            owner = np.array(written)[owner]
            inside = place < np.array([same[0][3] for same in owners])[owner]
            owner, place = owner[inside], place[inside]
            first = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(place, prepend=-2) != 1))
            last_ = np.append(first[1:], len(owner)) - 1
            for a, b in zip(first.tolist(), last_.tolist()):
                if len(owners[owner[a]]) == 1:  # those with several owners are repeated whole
                    n, p, s, _ = owners[owner[a]][0]
                    found.append((n, p, s + int(place[a]), s + int(place[b]) + 1))
        for k in range(0, len(found), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found[k:k + 10_000])],
                                             names=["anchor", "piece", "a", "b"])

    return texts.repartition(shards, "anchor", "key").sortWithinPartitions("anchor", "key").mapInArrow(sort, "anchor long, piece long, a long, b long")


def counted_repeats(texts: DataFrame) -> DataFrame:
    """``anchor, piece, a, b``: repeated windows of classes too large for one task. Windows of a
    class are equal if the common bytes, their place in the window and the others are."""
    k, others = F.col("k"), F.expr(f"substring(body, cast(k + 1 AS int), {LENGTH - COMMON})")
    windows = texts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("windows") - 1)).alias("k")).select(
        "anchor", "key", "piece", (F.col("skip") + k).alias("a"),
        F.md5(F.concat("common", others, (F.col("left") - k).cast("string").cast("binary"))).alias("window"))
    on = ["anchor", "key", "window"]
    often = stage_table(windows.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix-windows")
    met = salted(windows, often.drop("n"), often, on, ["piece"], "left_semi")
    return met.select("anchor", "piece", "a", (F.col("a") + 1).alias("b"))


def removed_mask(size: int, ranges: list) -> np.ndarray:
    step = np.zeros(size + 1, np.int64)
    if ranges:
        np.add.at(step, [r["a"] for r in ranges], 1)
        np.add.at(step, [r["b"] for r in ranges], -1)
    return np.cumsum(step[:-1]) > 0


def salted(left: DataFrame, right: DataFrame, counted: DataFrame, on: list[str], spread: list[str],
           how: str = "inner") -> DataFrame:
    """Join where no key of ``left`` is one task: keys with over a SALTS-th of the rows by
    ``counted`` (``on``, ``n``; fewer than SALTS such) are spread by a hash of ``spread``, and
    their rows of ``right``, at most one a kind of piece, are repeated for each salt."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot = F.lit(False)
    for key in counted.where(F.col("n") * SALTS > total).select(*on).collect():
        hot = hot | reduce(and_, (F.col(c) == F.lit(key[c]) for c in on))
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    every = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return left.withColumn("salt", F.when(hot, salt).otherwise(F.lit(0))).join(
        right.withColumn("salt", F.explode(every)), [*on, "salt"], how).drop("salt")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left)."""
    slim = text_bytes(docs).withColumn("text_hash", F.xxhash64("text"))
    cut = stage_table(cut_pieces(slim), "suffix-pieces")
    often = stage_table(cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix-anchors")
    pieces = stage_table(salted(cut, often.drop("n"), often, ["anchor"], ["doc_id", "first"], "left_semi"), "suffix-shared")
    drop_table(cut)
    kinds = stage_table(pieces.groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("n"), *(
        F.first(c).alias(c) for c in ("doc_id", "text_hash", "first", "windows", "place", "keys"))), "suffix-kinds")
    classes = kinds.select("*", F.posexplode("keys").alias("k", "key")).drop("keys", "n")
    both = stage_table(classes.groupBy("anchor", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix-keys")
    rows_ = both.agg(F.sum("n")).first()[0] or 0
    most = min(SHARD_SYMBOLS // (2 * CODED), max(CLASS_PIECES, rows_ // SALTS))  # pieces of a class that one task sorts
    number = F.floor((F.col("place") - F.col("windows") + 1) / F.lit(STEP)) + F.col("k")
    skip = F.greatest(F.lit(0), F.col("place") - STEP * F.col("number") - STEP + 1)
    until = F.least(F.col("windows"), F.col("place") - STEP * F.col("number") + 1)
    left = F.col("place") - STEP * F.col("number") - skip  # bytes before the class's common ones
    met = salted(classes, both.select("anchor", "key", (F.col("n") > most).alias("split")), both, ["anchor", "key"], ["piece"])
    shared = stage_table(met.withColumn("number", number).select(
        "doc_id", "text_hash", "anchor", "piece", "key", skip.cast("long").alias("skip"),
        (until - skip).cast("long").alias("windows"), (F.col("first") + skip).cast("long").alias("begin"),
        left.cast("long").alias("left"), "split"), "suffix-classes")
    size = shared.where("not split").agg(F.sum(F.col("windows") + CODED)).first()[0] or 0
    texts = stage_table(class_texts(slim, shared), "suffix-texts")
    sorted_ = sorted_repeats(texts.where("not split"), max(1, -(-int(size) // SHARD_SYMBOLS)))
    counted = counted_repeats(texts.where("split"))
    whole = kinds.where("n > 1").select("anchor", "piece", F.lit(0).cast("long").alias("a"),
                                        F.col("windows").cast("long").alias("b"))
    found = salted(pieces.select("doc_id", "text_hash", "anchor", "piece", "first"),
                   stage_table(whole.union(sorted_).union(counted), "suffix-ranges"), kinds.select("anchor", "piece", "n"),
                   ["anchor", "piece"], ["doc_id", "first"])
    ranges = found.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct(
        (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b") + LENGTH - 1).alias("b"))).alias("ranges"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for doc_id, text, found in rows(batch.slice(at, 256), "id", "text", "ranges"):
                    if not found:
                        out.append((doc_id, len(text), 0, 0, text))
                        continue
                    gone = removed_mask(len(text), found)
                    spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                    out.append((doc_id, len(text), int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.binary()])],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = slim.join(ranges, slim["id"].eqNullSafe(ranges["doc_id"]) & (slim["text_hash"] == ranges["text_hash"]), "left")
    return joined.select("id", "text", "ranges").mapInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
