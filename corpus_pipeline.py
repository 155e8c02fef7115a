"""Cleaning pipeline over ``documents``: five stages, each over all that the
stage before it kept, written as Parquet and reread.

1. quality rules: documents that fail a rule go;
2. SimHash near-duplicates: one document of each group stays;
3. benchmark decontamination: documents that hold a benchmark item go;
4. secret scans: live-looking credentials are masked in the texts;
5. byte-level BPE: every text as token ids, decoded again as a check.

Stages 1 to 4 return the columns of ``documents``; stage 5 returns the ids.

Defined results of every stage: a null text counts as empty (stage 1 lets
neither pass; taken alone, stages 2 to 5 keep them, empty texts being one group
of stage 2, and stage 5 gives them no ids); long texts are handled whole; of a
group of copies the row of least id stays (a null id counts as the largest; of
several texts under that id, or repeated rows, one by hash); in the other stages
repeated rows share their fate; an empty table gives none; columns of any
name, also those that the stages use inside, pass through as they are, except
that stage 4 brings ``n_chars`` up to date and stage 5 puts ``ids``,
``n_tokens`` and ``exact`` in place of ``text`` and of columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callcredit.llm import bpe, decontaminate, quality, secrets, simhash
from callcredit.llm.catalog import tokenizer
from callcredit.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, shingle=4, distance=4)


# Items of any length count: a page that holds a whole item of one word goes.
LEAST_WORDS = 1


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least_words=LEAST_WORDS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = "_repository"
    while own in map(str.lower, docs.columns):
        own += "_"
    marked = docs.withColumn(own, F.concat_ws("/", "source", "lang"))
    return secrets.redact(marked, repository=own, owner="source", length="n_chars").drop(own)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.checked_ids(docs, *tokenizer()).drop("text")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

# fingerprints, components and token ids are beyond SQL; tests/llm compares
# run() with a plain Python version of the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
