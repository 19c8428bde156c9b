"""The corpus pipeline: five stages over the documents table.

Each stage gets the documents its predecessor kept, works on all of them, and
is written as Parquet and read back as the next one's documents.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, jaccard, language, mixing, rans
from shelfwise.llm.common import reachable, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: texts without a letter, or in no language with a probability of a half, go."""
    reachable(spark)
    return language.keep_identified(docs, language.fit(docs))


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of documents linked by their shingles the one with the smallest id stays."""
    reachable(spark)
    return jaccard.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, reachable(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: every document as often as the mix takes it, whole."""
    reachable(spark)
    return mixing.mix(docs, whole=True)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token ids written in the binary format; the digest read back from the files."""
    reachable(spark)
    return rans.encoded_digest(docs)


STAGES = [
    ("language identification", identify_language),
    ("n-gram Jaccard join", join_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources", mix_sources),
    ("token ids in binary", encode_tokens),
]

ORACLE_SQL = None  # fitted models, random rounding and entropy coding are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table to the digest of the last one."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
