"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of ``documents``:

1. quality_rules      drops documents that fail a rule of the threshold table
2. near_dedup         keeps the document with the smallest id of each near-duplicate group
3. decontamination    drops documents that hold a window of a benchmark text
4. secrets            masks secrets in the texts (``n_chars`` follows)
5. packing            cuts the rest into pieces of sequences of at most 4096 tokens

Edge cases: null and empty texts and those of few words fail the quality rules; rows that
repeat id and text are one document from stage 2 on, and equal ids of different texts are
documents of their own; an empty table gives no pieces; an empty benchmark drops nothing;
further columns pass through stages 1 to 4 unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tastemap.llm._common import drop_table, read_table, stage_table
from tastemap.llm.decontaminate import drop_contaminated
from tastemap.llm.minhash import keep_representatives
from tastemap.llm.packing import pack_documents, piece_digests
from tastemap.llm.quality import keep_documents
from tastemap.llm.secrets import redact_secrets

#: Near copies share 5-word shingles to so many percent of both sets together.
SIMILARITY = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_representatives(docs, percent=SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digests(pack_documents(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        left = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if k:  # one copy of the corpus at a time: the stage before has been read
            drop_table(docs)
        docs = left
    return STAGES[-1][1](spark, docs, sf_dir)


#: Similarity components and tokenisation are beyond SQL; tests/llm/test_pipeline.py holds run() against
#: plain Python.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
