"""Operator 12, Merkle dataset manifest: a content-addressed DAG with inclusion proofs.

A row's leaf is the sha256 of its columns, each ``-`` if null, else byte count, ``:`` and
value. The leaves of a language in ascending id are folded eight at a time until one node is
left, its subroot; the subroots in order of language are folded alike into the root. Every
fold is kept as a record from a node's digest to its children's (equal nodes are one record).

A proof descends from the root: at each level the nodes on the way to some requested leaf are
joined with their records by digest, the child named by the rank's digit (base 8) goes on,
and the unselected children are kept as the level's path segment. A node carries its path
once for all leaves below it, so no digest is asked for by more rows than it has places in
the DAG. The last level meets the requests in runs of eight. Segments come root first and are
reversed for the proof, which lists siblings from the leaf's run to the root.

Ranks need no window over a language: rows are sorted by (language, id) into ranges, and each
range's start comes from a window over one row per range and language. All steps are joins
and aggregates on keys that hold eight rows at most; digests are 32 bytes in shuffles.

Edge cases: a null language is a language of its own, before all others; null ids come first;
rows with equal ids are ordered by leaf, and equal rows have equal leaves, so their order does
not show; a null text is ``-``, an empty one ``0:``; a language with one row has its leaf as
subroot and a table with one language that subroot as root; an empty table has no root and
gives no rows; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastemap.llm._common import crc32_sql, read_table, stage_table

#: Children of a node are 2**DIGIT_BITS; a rank's digits are read in groups of as many bits.
DIGIT_BITS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _told(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_hex(**changed: Column) -> Column:
    """A row's leaf as hex; ``changed`` replaces columns by other expressions."""
    values = [changed.get(c, F.col(c)).cast("string") for c in COLUMNS]
    return F.sha2(F.concat(*(_told(v) for v in values)), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    """The hex texts of an array of digests, one after the other."""
    return F.array_join(F.transform(digests, _hex), "")


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` (0.. within ``group`` in ascending ``order``, nulls first) and
    ``size`` (rows of the group). Ties are kept apart by their place in a written table."""
    tied = stage_table(rows.withColumn("_seq", F.monotonically_increasing_id()), f"{name}-rows")
    keys = [group, *order, "_seq"]
    flow = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_seq") \
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33))
    flow = stage_table(flow, f"{name}-sorted")
    of_group = Window.partitionBy("_group")
    before = of_group.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    runs = flow.groupBy(F.col("_range").alias("_r"), F.col(group).alias("_group")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).select(
        "_r", "_group", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(of_group).alias("size"))
    out = flow.join(runs, (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_group")))
    return out.withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")) \
        .drop("_at", "_range", "_r", "_group", "_first", "_before")


def _depth(size: int) -> int:
    """Levels of folds over ``size`` nodes."""
    depth = 0
    while size > 1:
        size, depth = -(-size >> DIGIT_BITS), depth + 1
    return depth


def fold_levels(nodes: DataFrame, group: str, name: str) -> list[DataFrame]:
    """The folds over ``group, rank, size, digest``: a table per level of ``group, rank, size,
    digest, children``, the lowest first; a group's last one has ``size`` 1."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    levels: list[DataFrame] = []
    for level in range(1, _depth(most) + 1):
        below = levels[-1] if levels else nodes
        run = below.where("size > 1").groupBy(group, F.shiftright("rank", DIGIT_BITS).alias("rank")).agg(
            F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("run"))
        run = run.withColumn("children", F.transform("run", lambda x: x["digest"]))
        size = F.shiftright(F.col("size") + ((1 << DIGIT_BITS) - 1), DIGIT_BITS)
        levels.append(stage_table(run.select(group, "rank", size.alias("size"),
                                             F.unhex(F.sha2(_joined(F.col("children")), 256)).alias("digest"), "children"),
                                  f"{name}-{level}"))
    return levels


def _records(level: DataFrame) -> DataFrame:
    """Digest to children: equal nodes are one record."""
    return level.select("digest", "children").dropDuplicates(["digest"])


def _segment(children: Column, digit: Column) -> Column:
    """The unselected children, left and right of a place, as bytes joined."""
    joined = lambda part: F.unhex(_joined(part))
    return F.struct(joined(F.slice(children, F.lit(1), digit)).alias("left"),
                    joined(F.slice(children, digit + 2, F.lit(1 << DIGIT_BITS))).alias("right"))


_NO_PATH = "array<struct<left:binary,right:binary>>"


@dataclass
class Manifest:
    """``leaves``: ``lang, rank, size, digest`` and the row's other columns; ``levels`` and
    ``top_levels``: records of the languages' trees and of the tree over them."""

    leaves: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame
    top_levels: list[DataFrame]
    root: bytes | None


def build_manifest(docs: DataFrame, **also: Column) -> Manifest:
    """Hash, rank and fold the rows of ``docs``. ``also``: further columns kept per leaf,
    computed in the same scan."""
    leaves = docs.select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.unhex(leaf_hex()).alias("digest"), *(c.alias(n) for n, c in also.items()))
    leaves = numbered(leaves, "lang", ["doc_id", "digest"], "merkle-leaves")
    levels = fold_levels(leaves, "lang", "merkle")
    ends = leaves
    done = ends.where("size = 1").select("lang", "digest", F.lit(0).alias("height"))
    for height, level in enumerate(levels, 1):
        done = done.unionByName(level.where("size = 1").select("lang", "digest", F.lit(height).alias("height")))
    subroots = stage_table(numbered(done.withColumn("all", F.lit(0)), "all", ["lang"], "merkle-subroots"), "merkle-subroots")
    top_levels = fold_levels(subroots, "all", "merkle-top")
    end = (top_levels[-1] if top_levels else subroots).select("digest").first()
    return Manifest(leaves, levels, subroots, top_levels, bytes(end[0]) if end else None)


def _descend(frontier: DataFrame, level: DataFrame, keep: list[str]) -> DataFrame:
    """One level down: ``frontier`` (``rank, digest, path`` and ``keep``) joined with its
    records by digest; each child with its path."""
    found = frontier.join(_records(level), "digest").select(
        *keep, "rank", "path", "children", F.posexplode("children").alias("digit", "child"))
    return found.select(*keep, (F.shiftleft("rank", DIGIT_BITS) + F.col("digit")).alias("rank"), F.col("child").alias("digest"),
                        F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"))


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (``lang, rank`` and other columns) with ``subroot`` and ``path``: the
    segments of unselected children, the leaf's own run first. Requests that name no leaf
    are left out."""
    top = manifest.top_levels[-1] if manifest.top_levels else manifest.subroots
    frontier = top.select("rank", "digest", F.array().cast(_NO_PATH).alias("path"))
    for level in reversed(manifest.top_levels):
        frontier = _descend(frontier, level, [])
    tops = stage_table(manifest.subroots.select("lang", "rank", "height").join(frontier, "rank").select(
        "lang", "height", F.lit(0).cast("long").alias("rank"), "digest", F.col("digest").alias("subroot"), "path"), "merkle-tops")
    keep = ["lang", "subroot"]
    prefix = F.shiftright("rank", DIGIT_BITS)
    wanted = stage_table(requests.select("lang", prefix.alias("rank")).distinct(), "merkle-wanted")
    frontier = None
    for height in range(len(manifest.levels), 0, -1):
        here = tops.where(F.col("height") == height).select(*keep, "rank", "digest", "path")
        frontier = here if frontier is None else frontier.unionByName(here)
        asked = wanted.select(F.col("lang").alias("_l"), F.shiftright("rank", DIGIT_BITS * (height - 1)).alias("_r")).distinct()
        frontier = frontier.join(asked, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("rank") == F.col("_r")), "left_semi")
        if height > 1:
            frontier = stage_table(_descend(frontier, manifest.levels[height - 1], keep), f"merkle-frontier-{height}")
    alone = tops.where("height = 0").select(
        F.col("lang").alias("_l"), F.col("rank").alias("_r"), "subroot", "path", F.lit(None).cast("array<binary>").alias("children"))
    if frontier is not None:
        alone = frontier.join(_records(manifest.levels[0]), "digest").select(
            F.col("lang").alias("_l"), F.col("rank").alias("_r"), "subroot", "path", "children").unionByName(alone)
    digit = F.col("rank").bitwiseAND((1 << DIGIT_BITS) - 1).cast("int")
    met = requests.join(alone, requests["lang"].eqNullSafe(F.col("_l")) & (F.shiftright(requests["rank"], DIGIT_BITS) == F.col("_r"))) \
        .where(F.col("children").isNull() & (F.col("rank") == 0) | (digit < F.size("children")))
    own = F.when(F.col("children").isNotNull(), F.array(_segment(F.col("children"), digit))) \
        .otherwise(F.array().cast(_NO_PATH))
    return met.withColumn("path", F.concat(own, F.reverse("path"))).drop("_l", "_r", "children")


def proof_hex(path: Column) -> Column:
    """sha256 of all siblings of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), ""), 256)


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(_hex(s["left"]), acc, _hex(s["right"])), 256))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and the root folded from its leaf as presented: every third
    document (by crc32 of its id) presents a text in lower case."""
    docs = read_table(spark, sf_dir, "documents").select(*COLUMNS)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % TAMPER_EVERY == 0, F.lit(False))
    text = F.when(tampered, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    manifest = build_manifest(docs, presented=F.unhex(leaf_hex(text=text)))
    told = proofs(manifest, manifest.leaves)
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    out = told.select("doc_id", _hex(F.col("digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), root.alias("root"),
                      proof_hex(F.col("path")).alias("proof_sha256"),
                      fold_path(_hex(F.col("presented")), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    part = lambda v: f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')"
    return f"sha256({' || '.join(part(text if c == 'text' else c) for c in COLUMNS)})"


def _fold_sql(name: str, group: str, levels: int) -> str:
    """CTEs ``<name>1..`` (folds of ``<name>0``) and ``<name>s0..`` (siblings of each node)."""
    out = ""
    for k in range(levels):
        out += f"""
{name}{k + 1} AS (
  SELECT {group}, idx // 8 AS idx, (any_value(size) + 7) // 8 AS size,
         CASE WHEN any_value(size) > 1 THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest
  FROM {name}{k} GROUP BY {group}, idx // 8),
{name}s{k} AS (
  SELECT a.{group}, a.idx, any_value(a.size) > 1 AS folds,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM {name}{k} a JOIN {name}{k} b ON a.{group} IS NOT DISTINCT FROM b.{group} AND a.idx // 8 = b.idx // 8
  GROUP BY a.{group}, a.idx),"""
    return out


def _oracle(levels: int = 8, top: int = 3) -> str:
    """Folds written out for languages of up to 8**levels rows and 8**top languages."""
    walk, steps = "", [("n", k) for k in range(levels)] + [("t", k) for k in range(top)]
    for i, (name, k) in enumerate(steps):
        on = (f"s.lang IS NOT DISTINCT FROM w.lang AND s.idx = w.idx >> {3 * k}" if name == "n"
              else f"s.g = 0 AND s.idx = w.top >> {3 * k}")
        walk += f"""
w{i + 1} AS (SELECT w.* EXCLUDE (acc, told), w.told || s.l || s.r AS told,
  CASE WHEN s.folds THEN sha256(s.l || w.acc || s.r) ELSE w.acc END AS acc FROM w{i} w JOIN {name}s{k} s ON {on}),"""
    return f"""
WITH d AS (
  SELECT doc_id, lang, {_leaf_sql('text')} AS leaf, {crc32_sql('doc_id::VARCHAR')} % {TAMPER_EVERY} = 0 AS tampered,
         {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS lowered FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
             count(*) OVER (PARTITION BY lang) AS size FROM d),
n0 AS (SELECT lang, idx, size, leaf AS digest FROM r),{_fold_sql('n', 'lang', levels)}
t0 AS (SELECT lang, 0 AS g, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS size, digest FROM n{levels}),{_fold_sql('t', 'g', top)}
w0 AS (SELECT r.*, t0.idx AS top, t0.digest AS subroot, '' AS told, CASE WHEN tampered THEN lowered ELSE leaf END AS acc
       FROM r JOIN t0 ON r.lang IS NOT DISTINCT FROM t0.lang),{walk}
e AS (SELECT *, (SELECT digest FROM t{top}) AS root FROM w{len(steps)})
SELECT doc_id, leaf, subroot, root, sha256(told) AS proof_sha256, acc AS folded_root, acc = root AS verified FROM e
"""


ORACLE = _oracle()
