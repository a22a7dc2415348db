"""A training corpus from raw documents: five stages, each one operator of ``notice_engine.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows it is given, and returns
the columns of ``documents``; the last returns tokens. Stages are written before the
next one reads them. Empty tables pass through; null, empty and very long texts,
repeated rows and extra columns follow the operators' own rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from notice_engine.llm import bpe, mixing, neardup, quality, substring
from notice_engine.session import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learned from these documents' labels, does not reject."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the smallest doc_id."""
    return neardup.without_near_duplicates(docs)


def cut_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of windows that an earlier document has too are cut out of text; n_chars follows."""
    return substring.without_repeated_substrings(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them: a repeated document is a repeated row, one left out is gone."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and digests of each row."""
    return bpe.encoded(docs, bpe.default_path())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", cut_repeated_substrings),
    ("mixing", mix_to_targets),
    ("encoding", encode),
]

#: Learned weights, signatures and merges are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
