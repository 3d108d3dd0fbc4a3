"""The corpus pipeline: five stages over documents, each written as Parquet and read again for the next."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferrocar.llm import common, decontaminate, quality, sentencepiece, simhash, toxicity
from ferrocar.llm.queries import TOKENIZERS
from ferrocar.session import apply_settings, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.clean(docs, common.table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of low quality go."""
    return quality.good(docs, common.table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies the document with the smallest id stays."""
    return simhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left, and whether they decode to the text."""
    return sentencepiece.tokenised(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", tokenise),
]

# Learnt models, fingerprints' components and Viterbi are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, applied to the documents of a data folder."""
    apply_settings(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
