"""Registered queries of this subpackage: name -> function of (spark, folder of test tables)."""

import os
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F

from shopflow.llm import (
    alignment, bpe, contamination, hmm, licenses, lines, neardup, parameters, quality, secrets, simhash, spelling, topk,
    urls)
from shopflow.llm.sql import ORACLE_SQL  # noqa: F401  registered with the queries

# Rows of an Arrow batch: texts are long, and a batch is held by Spark and by its worker.
BATCH_ROWS = 2_000

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES = {}


def register(fn):
    """Register a function of (spark, folder) under its own name."""
    def query(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = query
    return fn


def prepare(spark):
    """Session settings of these queries: batches to Python of a few MB of text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    importable(spark)


def importable(spark):
    """Let local workers import this package from where the driver did.

    On a cluster it is installed or sent with the job, as any other package.
    """
    if spark.sparkContext.master.startswith("local["):
        root = str(Path(__file__).resolve().parents[2])
        environment = spark.sparkContext.environment
        paths = environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_url_filter(spark, sf_dir):
    rules = [urls.host_rule(a, p) for a, p in parameters.HOST_RULES]
    rules += [urls.wildcard_rule(a, p) for a, p in parameters.WILDCARD_RULES]
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, rules).drop("url")


@register
def op2_line_dedup(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.dedup(documents).drop("source")


def _remainder(n):
    """crc32 of the document's id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def quality_weights(spark, sf_dir, docs):
    """Learned from labels of ``docs`` that are not held out."""
    labels = table(spark, sf_dir, "labels").where(_remainder(5) != 0)
    return quality.fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))


@register
def op3_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    scored = quality.score(documents, quality_weights(spark, sf_dir, documents))
    return scored.select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "score",
        (F.col("score") >= parameters.QUALITY_CUT).cast("int").alias("predicted"))


@register
def op4_license_scan(spark, sf_dir):
    return licenses.summary(table(spark, sf_dir, "documents"))


@register
def op5_decontamination(spark, sf_dir):
    documents, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return contamination.flagged(documents, benchmark)


@register
def op6_near_dup(spark, sf_dir):
    return neardup.groups(table(spark, sf_dir, "documents"), size=2)


@register
def op7_secret_scan(spark, sf_dir):
    return secrets.summary(table(spark, sf_dir, "documents"))


@register
def op8_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@register
def op9_hmm_score(spark, sf_dir):
    return hmm.score(table(spark, sf_dir, "documents"), _remainder(10) != 0)


@register
def op10_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path(VOCABULARY)
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@register
def op11_alignment(spark, sf_dir):
    a, b = map(public_tokenizers.path, ALIGNED)
    return alignment.summary(table(spark, sf_dir, "documents"), a, b)


@register
def op12_simhash(spark, sf_dir):
    return simhash.groups(table(spark, sf_dir, "documents"))


@register
def op13_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))
