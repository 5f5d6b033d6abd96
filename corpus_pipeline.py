"""Cleaning and mixing of a training corpus: five stages, each one operator over the whole table.

``run`` applies the stages in order; each result is written as Parquet in the
shared folder and read again as the next stage's documents. All stages but the
last return the columns of ``documents``; the last adds what the mix decided.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentlens.llm import toxicity
from rentlens.llm.common import saved
from rentlens.llm.decontaminate import remove_contaminated
from rentlens.llm.exact_dedup import keep_last
from rentlens.llm.jaccard_join import keep_one
from rentlens.llm.mixing import mix

#: The near-copy rule of a corpus: shingles of five words, Jaccard similarity of 0.8 (op3's 4 and 0.85 are that query's alone).
NEAR_WORDS, NEAR_PART = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not predict to be toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return keep_last(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one with the smallest id."""
    return keep_one(docs, words=NEAR_WORDS, part=NEAR_PART)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark passages to the extent of the contamination rule."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes (once or twice), with size, source_size, target, copies and taken."""
    return mix(docs).filter("copies > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

#: The classifier has no SQL form; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
