r"""Operator 7, near-duplicate groups by b-bit MinHash with exact confirmation.

A document's set holds the 64-bit hashes of its 5-word shingles. Equal sets form a class,
and only classes are compared:

1. 256 minima per set. Bands of 4 full minima are the bucket keys, as many as the threshold
   needs (20 for 85 %, 28 for 80 %); of every minimum only the low 4 bits are kept, packed in 4 planes of 256 bits (128 bytes a class).
2. In each bucket, pairs are compared by bit counts: with an agreement share p, the
   collision-corrected estimate is (p - 1/16) / (1 - 1/16). Pairs under the threshold less
   five standard errors are dropped; of the others a spanning forest leaves the bucket, so a
   bucket of n classes emits at most n - 1 rows.
3. The forests' components are the candidate groups. Each group's full sets meet once; in it
   pairs are taken by falling estimate and confirmed on the full sets, unless the group's
   confirmed links connect them already. Again at most n - 1 links leave.
4. Components of the confirmed links, over classes, give each document its smallest id.

Buckets and groups over ``CELL`` members are dealt into cells, pairs of blocks of members,
so no task holds a whole hot group; every pair of members still meets in one cell. A pair at
the threshold is missed by all bands with probability 4e-7 and by the estimate with 3e-7;
confirmed links are exact (up to equal 64-bit hashes of different shingles).

Edge cases: null or blank texts have empty sets, n_shingles 0, and stand alone; texts of
fewer than five words have one shingle, the whole sequence; repeated rows are in one class;
a null doc_id takes part, but is no group's smallest id unless all are null; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm._common import SPACE, mix64, read_table, rows, stage_table
from tastemap.llm.components import components

SHINGLE = 5
MINIMA = 256
BITS = 4
ROWS = 4
MISS = 4e-7
PERCENT = 85
CELL = 1024

_RNG = np.random.default_rng(20_240)
_MUL = _RNG.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash by word, kept while the store is small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = text.lower().split()  # A-Z; ASCII white space
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    a = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(n, size)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = mix64(out * _FOLD + a[k:n - width + 1 + k])
    return np.unique(out)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """``len(sets) x MINIMA`` minima, in runs of sets that fit the cache."""
    out = np.empty((len(sets), MINIMA), np.uint64)
    first = 0
    while first < len(sets):
        last, total = first + 1, len(sets[first])
        while last < len(sets) and total + len(sets[last]) <= 1 << 15:
            total += len(sets[last])
            last += 1
        flat = np.concatenate(sets[first:last])
        starts = np.cumsum([0] + [len(s) for s in sets[first:last - 1]])
        for k in range(MINIMA):
            out[first:last, k] = np.minimum.reduceat(flat * _MUL[k] + _ADD[k], starts)
        first = last
    return out


def band_count(percent: int = PERCENT) -> int:
    """The fewest bands that miss a pair at the threshold with probability MISS or less."""
    bands = int(np.ceil(np.log(MISS) / np.log1p(-(percent / 100) ** ROWS))) if percent < 100 else 1
    if bands > MINIMA // ROWS:
        raise ValueError(f"{MINIMA} minima are too few for a threshold of {percent} %")
    return bands


def band_keys(mins: np.ndarray, bands: int) -> np.ndarray:
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(mins), bands))
    for r in range(ROWS):
        keys = mix64(keys * _FOLD + mins[:, r:ROWS * bands:ROWS])
    return keys.view(np.int64)


def packed(mins: np.ndarray) -> np.ndarray:
    """Low bits of (mixed) minima as BITS planes of MINIMA bits."""
    low = mix64(mins)
    planes = [np.packbits((low >> np.uint64(b)) & np.uint64(1) == 1, axis=1) for b in range(BITS)]
    return np.concatenate(planes, axis=1)


_WORDS = MINIMA // 64


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarity of a packed signature (as uint64) to each of ``others``."""
    differ = one ^ others
    off = differ[:, :_WORDS]
    for b in range(1, BITS):
        off = off | differ[:, b * _WORDS:(b + 1) * _WORDS]
    share = 1 - np.bitwise_count(off).sum(axis=1) / MINIMA
    chance = 2.0 ** -BITS
    return (share - chance) / (1 - chance)


def estimate_floor(percent: int = PERCENT) -> float:
    """Threshold less five standard errors of the estimate there."""
    chance, j = 2.0 ** -BITS, percent / 100
    p = j + (1 - j) * chance
    return j - 5 * np.sqrt(p * (1 - p) / MINIMA) / (1 - chance)


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _signatures(part: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(part), np.uint64).reshape(len(part), -1)


def bucket_forest(sizes: np.ndarray, signatures: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose estimate and sizes allow a link."""
    floor, forest, out = estimate_floor(percent), Forest(len(sizes)), []
    left = np.arange(len(sizes))  # not yet reached; a reached member is compared with these
    while len(left):
        stack, left = [int(left[0])], left[1:]
        while stack and len(left):
            x = stack.pop()
            near = (estimates(signatures[x], signatures[left]) >= floor) \
                & (100 * np.minimum(sizes[x], sizes[left]) >= percent * np.maximum(sizes[x], sizes[left]))
            for y in left[near].tolist():
                forest.join(x, y)
                out.append((x, y))
                stack.append(y)
            left = left[~near]
    return out


def confirmed_forest(sets: list[np.ndarray], signatures: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the links that hold on the full sets."""
    sizes = np.array([len(s) for s in sets])
    floor, forest, out = estimate_floor(percent), Forest(len(sets)), []
    pairs, told = [], []
    for x in range(len(sets) - 1):
        told_x = estimates(signatures[x], signatures[x + 1:])
        near = np.flatnonzero((told_x >= floor) & (
            100 * np.minimum(sizes[x], sizes[x + 1:]) >= percent * np.maximum(sizes[x], sizes[x + 1:])))
        pairs.append(np.stack([np.full(len(near), x, np.int32), (x + 1 + near).astype(np.int32)], axis=1))
        told.append(told_x[near].astype(np.float32))
    if not pairs:
        return out
    pairs, told = np.concatenate(pairs), np.concatenate(told)
    for x, y in pairs[np.argsort(-told, kind="stable")].tolist():
        if forest.find(x) != forest.find(y):
            merged = np.concatenate([sets[x], sets[y]])
            merged.sort()
            common = int((merged[1:] == merged[:-1]).sum())
            if 100 * common >= percent * (len(merged) - common):
                forest.join(x, y)
                out.append((x, y))
    return out


def _text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def document_signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        percent: int = PERCENT) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node, signature, bands``; ``node`` names the class (digest
    of the set, null for an empty one)."""
    bands = band_count(percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = list(rows(batch.slice(at, 512), "id", "text_hash", "text"))
                sets = [shingle_set(t, hashes) for _, _, t in part]
                full = [s for s in sets if len(s)]
                mins = minima(full)
                keys, bits = iter(band_keys(mins, bands).tolist()), iter(packed(mins))
                out = [(i, h, len(s), *((xxhash.xxh3_128_digest(s.tobytes()), next(bits).tobytes(), next(keys))
                                        if len(s) else (None, None, None))) for (i, h, _), s in zip(part, sets)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())))],
                    names=["doc_id", "text_hash", "n_shingles", "node", "signature", "bands"])

    slim = docs.select(F.col(id_col).cast("long").alias("id"), _text(text_col).alias("text")) \
        .select("id", F.xxhash64("text").alias("text_hash"), "text")
    return slim.mapInArrow(sign, "doc_id long, text_hash long, n_shingles long, node binary, signature binary, "
                                 "bands array<long>")


def in_cells(members: DataFrame, key: str, size: str, cell: int = CELL) -> DataFrame:
    """Deal the members of each key into block pairs ``ci <= cj`` of about ``cell`` members."""
    blocks = F.ceil(F.col(size) / F.lit(cell)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    out = members.withColumn("_blocks", blocks).withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return out.withColumns({"ci": F.least("_own", "_other"), "cj": F.greatest("_own", "_other")}) \
        .drop("_blocks", "_own", "_other", size).repartition(key, "ci", "cj").sortWithinPartitions(key, "ci", "cj", "node")


def _by_cell(batches: Iterator[pa.RecordBatch], key: str, *names: str) -> Iterator[list[tuple]]:
    """Rows of one cell after the other (they come sorted); a node counts once."""
    last, group = None, []
    for batch in batches:
        for row in rows(batch, key, "ci", "cj", "node", *names):
            if row[:3] != last:
                if len(group) > 1:
                    yield group
                last, group = row[:3], []
            if not group or group[-1][0] != row[3]:
                group.append(row[3:])
    if len(group) > 1:
        yield group


def _edges(pairs: Iterator[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    found = list(pairs)
    for at in range(0, len(found), 10_000):
        a, b = zip(*found[at:at + 10_000])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def candidate_edges(classes: DataFrame, percent: int = PERCENT, cell: int = CELL) -> DataFrame:
    """Edges ``a, b`` whose components are those of all pairs that share a bucket and pass the
    estimate."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_cell(batches, "key", "n_shingles", "signature"):
            sizes = np.array([g[1] for g in group])
            yield from _edges((group[x][0], group[y][0])
                              for x, y in bucket_forest(sizes, _signatures([g[2] for g in group]), percent))

    member = classes.select("node", F.explode("bands").alias("key"))
    shared = member.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    member = member.join(shared, "key").join(classes.select("node", "n_shingles", "signature"), "node")
    return in_cells(member, "key", "n", cell).mapInArrow(compare, "a binary, b binary")


def confirmed_edges(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, cell: int = CELL) -> DataFrame:
    """Links ``a, b`` confirmed on full sets. ``groups``: ``node, rep, root, size, signature``
    (``rep``: a document that has the node's set; ``size``: members of ``root``'s group)."""
    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t, hashes).tobytes() for t, in rows(part, "text")]
                # Another text under the same id has another digest.
                own = pa.array([xxhash.xxh3_128_digest(s) == n for s, (n,) in zip(sets, rows(part, "node"))])
                at_text = part.schema.get_field_index("text")
                yield part.set_column(at_text, "shingles", pa.array(sets, pa.binary())).filter(own)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_cell(batches, "root", "shingles", "signature"):
            yield from _edges((group[x][0], group[y][0]) for x, y in confirmed_forest(
                [np.frombuffer(g[1], np.uint64) for g in group], _signatures([g[2] for g in group]), percent))

    texts = docs.select(F.col(id_col).cast("long").alias("rep"), _text(text_col).alias("text"))
    needed = groups.join(texts, groups["rep"].eqNullSafe(texts["rep"])).select(
        "node", "root", "size", "signature", "text")
    loaded = needed.mapInArrow(load, "node binary, root binary, size long, signature binary, shingles binary")
    return in_cells(loaded, "root", "size", cell).mapInArrow(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_shingles, component_id, kept``."""
    signed = stage_table(document_signatures(docs, id_col, text_col, percent), "minhash-documents")
    classes = stage_table(signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"), F.first("bands").alias("bands")), "minhash-classes")
    tied = components(candidate_edges(classes, percent), "minhash-candidates")
    member = tied.union(tied.select("root", "root").distinct())
    size = member.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    groups = member.join(size, "root").join(classes.select("node", "rep", "signature"), "node")
    linked = components(confirmed_edges(docs, groups, id_col, text_col, percent), "minhash-links")
    own = classes.select("node", "rep").join(linked, "node", "left") \
        .select("node", "rep", F.coalesce("root", "node").alias("root"))
    least = own.groupBy("root").agg(F.min("rep").alias("component"))
    label = own.join(least, "root").select("node", "component")
    out = signed.select("doc_id", "text_hash", "n_shingles", "node").join(label, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         percent: int = PERCENT) -> DataFrame:
    """One document of each group, and all documents without words, with their own columns.
    Rows that repeat both id and text are one document."""
    kept = near_duplicates(docs, id_col, text_col, percent).where("kept and n_shingles > 0") \
        .select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash")).distinct()
    wordless = ~F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(f"[^{SPACE}]")
    # whole rows travel in a struct, so that no column of theirs can clash
    worded = docs.where(~wordless).select(F.struct("*").alias("row"), F.xxhash64(_text(text_col)).alias("_hash"),
                                          F.col(id_col).cast("long").alias("_id"))
    worded = worded.join(kept, worded["_id"].eqNullSafe(F.col("_kept_id")) & (worded["_hash"] == F.col("_kept_hash")),
                         "left_semi").dropDuplicates(["_id", "_hash"]).select("row.*")
    return worded.unionByName(docs.where(wordless))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_hash")
