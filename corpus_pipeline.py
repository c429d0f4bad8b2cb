"""From raw documents to a weighted training mix, in five written stages."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from paceframe.llm import decontaminate, lines, mixing, quality, shingles
from paceframe.llm.queries import HELD_OUT
from paceframe.llm.store import materialise
from paceframe.sources.tables import read_table

#: A language-agnostic SQL check of run() is not possible: the classifier is a trained model.
ORACLE_SQL = None

SHINGLE_WORDS = 5
SHINGLE_SIMILARITY = Fraction(4, 5)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' votes do not reject."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"), held_out=HELD_OUT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand on many sites; the first document keeps them."""
    return lines.clean(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words and 0.8, where op3 has three and 0.9."""
    return shingles.keep_one(docs, size=SHINGLE_WORDS, threshold=SHINGLE_SIMILARITY)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Weight, number of copies, block and place of every document in the mix."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
