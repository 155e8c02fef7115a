"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, chat, decontaminate, lexical, licenses, maxent, oracle, quality, secrets, simhash, suffixes, superkmers, warc
from .text import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(oracle.SQL)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and verdict of every document."""
    return quality.annotate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed_rules")


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document: 4-word shingles, 4 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they hold."""
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least_words=1)
    return found.select("doc_id", "item_id", "item_words", "equal_words", "window_equal")


def tokenizer() -> tuple[str, str]:
    """Rank file and split pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), *tokenizer())


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document, and how many look live; a document's source
    is its owner, source and language its repository."""
    docs = table(spark, sf_dir, "documents").withColumn("repository", F.concat_ws("/", "source", "lang"))
    found = secrets.scan(docs, repository="repository", owner="source")
    spans = F.col("spans")
    of = lambda *kinds: F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(secrets.spans_text(of(*secrets.BASE)), 256).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("bigint").alias("n_live"))


@query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and one of control strings, formatted and read back."""
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.read_back(chat.format_chats(turns))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences of every document: whole texts and whole lines."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_table(spark))


@query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every document."""
    return maxent.fit_and_score(table(spark, sf_dir, "documents"))


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings that start earlier."""
    done = suffixes.deduplicate(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 35-word windows that start elsewhere too."""
    done = superkmers.deduplicate(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in a byte-level and a piece vocabulary, aligned."""
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
