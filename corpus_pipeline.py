"""The training-data pipeline: documents through the operators of streamcharts.llm, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamcharts.llm import exact_dedup, mixing, near_dedup, segmentation, toxicity
from streamcharts.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-channel classifier scores below one half."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest identifier."""
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest identifier."""
    return near_dedup.kept_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix copies it."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document of the mix, and digest and length of the text that each decodes to."""
    return segmentation.encode(docs, spelled=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("SentencePiece", encode_pieces),
]

ORACLE_SQL = None  # draws of the mix and of the segmentations are hashes that SQL does not have


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
