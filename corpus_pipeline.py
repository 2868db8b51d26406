"""From raw documents to packed sequences: five stages, each written as Parquet and read by the next.

Every stage works on all rows that the one before it kept, and all but the last return the columns of
``documents``: a stage drops rows or changes ``text`` (and ``n_chars`` with it), never the shape. Null and
empty texts, null and repeated doc_ids, extra columns and empty tables are handled as the operators' own
docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kymora.llm import neardups, packing, quality, secrets, substrings
from kymora.llm.common import shared_folder

TOKENIZER, END_ID, CAPACITY = "word_bpe_49k.json", 1, 4096


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return neardups.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that occurred before; all rows stay."""
    return substrings.cut_out(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """Documents with secrets replaced by a mark; all rows stay. A ledger of an earlier run spares what it has seen."""
    return secrets.redact_documents(docs, secrets.Ledger(spark, ledger))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID, CAPACITY)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]
ORACLE_SQL = None  # suffix arrays, SimHash groups and packing have no SQL form; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the written result of the last."""
    folder = f"{shared_folder(spark)}-pipeline"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
