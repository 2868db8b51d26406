"""The registered queries of this folder, with SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kymora.llm import audit, bpe, classlm, packing, phrases, quality, runs, secrets, simhash, substrings, token_blocks, token_counts, windows

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as files of patched blocks, and read back."""
    folder = token_blocks.token_folder(spark)
    files = token_blocks.write_token_files(documents(spark, sf_dir), folder, public_tokenizers.path(WORDS), end_id=2)
    return token_blocks.read_token_files(files)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and whether there are more than 512."""
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(BYTES), limit=512)


def op3_secrets(spark: SparkSession, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """Secrets of every document, by way of a ledger of blobs; one that an earlier run left spares its blobs."""
    return secrets.span_digest(secrets.scan(documents(spark, sf_dir), secrets.Ledger(spark, ledger)))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4,096 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path(WORDS), end_id=1, capacity=4096)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in 20-word windows that occurred before, removed from every document."""
    return substrings.remove_repeats(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition rules for every document."""
    got = quality.quality(documents(spark, sf_dir))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "longest_repeat")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the group of near-duplicates that it is in."""
    got = simhash.near_duplicates(documents(spark, sf_dir), width=3, tau=2)
    return got.select("doc_id", simhash.hex_print(got["fp"]).alias("fingerprint"), "component_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own BPE encoding of every document, and its decoding."""
    return bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path(WORDS))


def op9_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return phrases.phrase_fingerprints(documents(spark, sf_dir))


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability in a class-based bigram model."""
    return classlm.score(documents(spark, sf_dir))


def op11_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of at most 2,048 tokens, packed as they stream past."""
    return windows.pack_windows(documents(spark, sf_dir), public_tokenizers.path(WORDS), end_id=1, capacity=2048)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of periodic words in every document, some of which get a periodic end first."""
    return runs.periodic_runs(documents(spark, sf_dir), plant=True)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order of them, for each language."""
    return audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files, op2_token_counts, op3_secrets, op4_packing, op5_substrings, op6_quality, op7_simhash, op8_bpe, op9_phrases, op10_class_lm,
        op11_windows, op12_periodic_runs, op13_filter_audit,
    )
}
ORACLES: dict[str, str] = {"op3_secrets": secrets.ORACLE, "op13_filter_audit": audit.ORACLE}
