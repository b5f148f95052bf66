"""Operator 1, quality rules: a table of thresholds compiled into one Spark projection.

Every measure and every verdict is a built-in column expression; no row leaves the JVM
and nothing is shuffled. Ratios are compared in integers (``100 * part`` against
``percent * whole``), so no verdict hangs on rounding.

Edge cases: a null or blank text has no words, so every count is 0 and the document fails
the base rule; a repeated ``doc_id`` gives one result per row; an empty table gives an
empty result; input columns other than the id and the text never clash with the measures,
because only those two are read (``keep_documents`` carries whole input rows in a struct).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm._common import SPACE, read_table

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Very frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and in to a is that it was for on with as by at from this are be or an "
    "le la les de des du et un une que en dans par pour qui "
    "der die das und ist von zu den ein eine im mit sich auf für nicht "
    "el los las y se del una con lo es por como su"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails when ``100 * part`` leaves ``[low, high] * whole``; the rule holds
    from ``min_words`` words on. ``low``/``high`` are percent; None leaves a side open."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    min_words: int = 0

    def failed(self) -> Column:
        part, whole = 100 * F.col(self.part), F.col(self.whole)
        out = F.lit(False)
        if self.low is not None:
            out = out | (part < self.low * whole)
        if self.high is not None:
            out = out | (part > self.high * whole)
        return out & (F.col("n_words") >= self.min_words)

    def sql(self) -> str:
        sides = [f"100*{self.part} < {self.low}*{self.whole}"] * (self.low is not None) \
            + [f"100*{self.part} > {self.high}*{self.whole}"] * (self.high is not None)
        return f"(n_words >= {self.min_words} AND ({' OR '.join(sides)}))"


#: The threshold table. Percentages of words, or of lines that hold a word.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1200, min_words=20),
    Rule("symbols", "n_symbols", "n_words", high=30),
    Rule("exclamations", "n_bangs", "n_words", high=60),
    Rule("stop_words", "n_stop_words", "n_words", low=3, min_words=80),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
)
BASE_MIN_WORDS = 20
BASE_REPEAT_PERCENT = 30


def _chained(arrays: str, step: int) -> Column:
    """Hash each element with the one ``step`` further: three rounds (1, 2, 4) turn word
    hashes into hashes of 8-word windows. The last ``step`` elements have no partner."""
    return F.transform(arrays, lambda x, i: F.xxhash64(x, F.get(F.col(arrays), i + step)))


def _measures(df: DataFrame, text: Column) -> DataFrame:
    """``df`` plus the measures. Steps that a later one reads several times are columns of
    their own, so that Catalyst evaluates each once."""
    df = df.select("*", F.coalesce(text.cast("string"), F.lit("")).alias("_text"))
    df = df.select("*", F.filter(F.split("_text", f"[{SPACE}]+"), lambda w: w != "").alias("_words"),
                   F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("_lines"))
    df = df.select("*", F.array_join("_words", "").alias("_joined"),
                   F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    df = df.select("*", _chained("_hashes", 1).alias("_pairs"))
    df = df.select("*", _chained("_pairs", 2).alias("_fours"))
    df = df.select("*", F.slice(_chained("_fours", 4), F.lit(1), F.greatest(
        F.size("_hashes") - (WINDOW - 1), F.lit(0))).alias("_windows"))
    # Only texts with a repeated window are sorted: equal hashes then stand side by side.
    df = df.select("*", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("h"), i.alias("p")))))
        .alias("_sorted"))
    near = lambda i: F.get(F.col("_sorted"), i)["h"]
    df = df.select("*", F.sort_array(F.transform(F.filter(
        "_sorted", lambda s, i: F.coalesce(s["h"] == near(i - 1), F.lit(False))
        | F.coalesce(s["h"] == near(i + 1), F.lit(False))), lambda s: s["p"])).alias("_starts"))
    covered = F.aggregate(  # each window adds the words after the end of the one before it
        "_starts", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"])
    # Stop words are matched by word hash, in lower case and capitalised.
    stops = [F.xxhash64(F.lit(w)) for x in STOP_WORDS for w in (x, x.capitalize())]
    return df.select(
        "*", F.size("_hashes").cast("long").alias("n_words"),
        F.length("_joined").cast("long").alias("word_chars"),
        F.regexp_count("_joined", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.length("_joined") - F.length(F.replace("_joined", F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_hashes", lambda h: h.isin(stops))).cast("long").alias("n_stop_words"))


def _verdict(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    base = (F.col("n_words") < BASE_MIN_WORDS) \
        | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words"))
    failed = F.array_compact(F.array(*(F.when(r.failed(), F.lit(r.name)) for r in rules)))
    df = df.select("*", base.alias("base_failed"), F.array_join(failed, ",").alias("failed_rules"))
    return df.select("*", (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"))


RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
          "kept", "n_bangs", "n_lines", "n_stop_words", "failed_rules")


def _pinned(column: str) -> Column:
    """The column, not deterministic to the optimizer: a caller's filter on it would else be
    pushed below the measures, each copied into it as often as it is used."""
    return F.when(F.monotonically_increasing_id() >= 0, F.col(column)).alias(column)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: the measures, the base verdict, the names of failed rules
    (comma-joined, in table order) and ``kept``."""
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_raw"))
    out = _verdict(_measures(slim, F.col("_raw")), rules)
    return out.select(F.col("_id").alias(id_col), *(_pinned(c) for c in RESULT))


def keep_documents(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass every rule, with exactly the columns they came with."""
    slim = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"),
                       docs[text_col].alias("_raw"))
    return _verdict(_measures(slim, F.col("_raw")), rules).select("_row", _pinned("kept")).where("kept").select("_row.*")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents"))


_STOP_LIST = ", ".join(f"'{w}'" for x in STOP_WORDS for w in (x, x.capitalize()))
ORACLE = f"""
WITH base AS (
  SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, k, regexp_extract_all(t, '[^{SPACE}]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS lines
  FROM base),
win AS (
  SELECT k, p, array_to_string(words[p:p + {WINDOW - 1}], chr(10)) AS g
  FROM (SELECT k, words, unnest(range(1, len(words) - {WINDOW - 2})) AS p FROM w)),
rep AS (
  SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT k, sum(least({WINDOW}, p - prev)) AS n FROM (
    SELECT k, p, coalesce(lag(p) OVER (PARTITION BY k ORDER BY p), p - {WINDOW}) AS prev FROM rep)
  GROUP BY k),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(array_to_string(words, ''), '[^{SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(array_to_string(words, ''), '[^!]', '', 'g'))::BIGINT AS n_bangs,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda x: x IN ({_STOP_LIST})))::BIGINT AS n_stop_words
  FROM w LEFT JOIN cov USING (k)),
v AS (
  SELECT *, (n_words < {BASE_MIN_WORDS} OR 100*n_repeat_words > {BASE_REPEAT_PERCENT}*n_words) AS base_failed,
         concat_ws(',', {', '.join(f"CASE WHEN {r.sql()} THEN '{r.name}' END" for r in RULES)}) AS failed_rules
  FROM m)
SELECT *, (NOT base_failed AND failed_rules = '') AS kept FROM v
"""
