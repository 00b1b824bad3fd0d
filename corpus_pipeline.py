"""Document pipeline: each stage works on what its predecessor kept.

Every stage but the last returns the columns of documents. Documents that the language classifier rejects go; one
document of each group of near-duplicates (a Jaccard similarity of 0.8 or more of their five-word shingles) stays, the
one with the least doc_id; documents in which a benchmark passage occurs go; secrets are replaced in the text and
n_chars follows; packing returns its pieces.

Results by case, for all stages: extra columns of any name are carried along; a very long text is worked whole, in one
task; an empty table of documents gives empty results, an empty benchmark removes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickerloom.llm import decontaminate, language_id, near_copies, packing, secret_scan, simhash_dedup
from tickerloom.llm.tables import on_the_way, release, saved, small_batches, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay. Null texts and texts without a letter go; null langs and null doc_ids are judged like others, but not learned from; repeated rows all stay or all go; without any known lang nothing stays, as no language is learned."""
    small_batches(spark)
    return language_id.identified_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays. Null and empty texts are copies of each other; of repeated rows of one doc_id one stays; rows without doc_id stay, as no order tells which of them is first."""
    small_batches(spark)
    return simhash_dedup.keep_least(docs, near_copies.near_copies(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage stay, with null and empty texts; items without an id count; repeated rows all stay or all go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; null texts stay null, and what has no secret stays as it is, n_chars included; repeated rows are redacted alike."""
    small_batches(spark)
    return secret_scan.redact(docs, secret_scan.train(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents; null and empty texts are their end token; repeated rows and null doc_ids each have pieces."""
    small_batches(spark)
    return packing.pack_documents(docs, *packing.public_vocabulary())


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]

#: Learned models, fingerprints and packing have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written to the shared folder and read again; what a stage has written on the way goes when it is done."""
    docs = table(spark, sf_dir, "documents")
    with on_the_way() as paths:
        for name, stage in STAGES[:-1]:
            docs = saved(stage(spark, docs, sf_dir), name)
            release(spark, paths, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
