"""The corpus pipeline: documents are judged, cleaned, deduplicated, decontaminated, tokenised.

Every stage works on what the one before kept. Stages but the last return the columns of
``documents``.
"""

import uuid
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopflow.llm import bpe, contamination, lines, neardup, parameters, quality
from shopflow.llm.queries import VOCABULARY, prepare, quality_weights, table
from shopflow.sources import stage

SHINGLE_WORDS = 5
PERCENT = 80


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality.accept(docs, quality_weights(spark, sf_dir, docs), parameters.QUALITY_CUT)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that a source repeats go; ``n_chars`` follows the text."""
    cut = lines.cut(docs)
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType))
    return cut


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group the document of the least id stays."""
    return neardup.survivors(docs, SHINGLE_WORDS, PERCENT)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark passage go."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: token count and digests of the ids and of the decoded bytes."""
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def _prepared(function):
    @wraps(function)
    def stage_function(spark, docs, sf_dir):
        prepare(spark)
        return function(spark, docs, sf_dir)

    return stage_function


STAGES = [
    ("quality", _prepared(accepted)),
    ("line_dedup", _prepared(without_boilerplate)),
    ("near_dedup", _prepared(without_near_copies)),
    ("decontamination", _prepared(without_leaks)),
    ("byte_bpe", _prepared(tokens)),
]

# The first stage learns a model and the third branches by hash: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = f"{stage.folder(spark)}/corpus-{name}-{uuid.uuid4().hex}"
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
