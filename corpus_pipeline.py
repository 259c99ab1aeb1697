"""The corpus pipeline: stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from asofworks.llm import lines, minhash, mixing, pieces, quality
from asofworks.llm.store import kept, read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network rejects go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go, and documents that lose all their lines."""
    return lines.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays as often as the mix takes it."""
    return mixing.mixed(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens): the piece ids of each document of the mix."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("mixing to target weights", source_mixing),
    ("sentencepiece encoding", piece_encoding),
]

#: No SQL: the classifier, the near-dedup and the encoding are beyond it; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = kept(docs, "stage") if k < len(STAGES) - 1 else docs
    return docs
