"""Revenue per document and per call (A1, A2, B7) kept current.

The state is one row per document (its sales, counts, extremes, mentions and
contract flags) and one row per call.  A batch adds and drops invoice lines
and mentions; a changed row is a dropped one and an added one.

1. Sums and counts of the documents that the batch names take signed deltas:
   plus for added rows, minus for dropped ones.
2. A minimum or maximum cannot be taken back, so the extremes of documents
   that lost a line are taken anew from these documents' lines; those of
   documents that only gained lines are compared with the added lines.
3. The contract flags of the named documents follow from their new row; the
   few that the row does not decide are matched with their own lines.
4. Calls that mention a named document, or whose mentions changed, are
   credited anew from the document rows; all other calls stay.

No step reads the lines of a document that the batch does not name.  The
results equal a full build in the strict mode of :mod:`.revenue`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .revenue import DOC, SALES, _flags_of, _on_contract, _typed_lines, sales_type

CALL = "MeetingId"
_FIRST = ("min_sales", "min_open", "min_start")
_LAST = ("max_sales", "max_end")
_COUNTS = ("sales", "n_lines", "n_sales", "n_calls")


@dataclass
class Changes:
    """Added and dropped rows of the invoice lines and of the mentions."""

    added_lines: DataFrame
    dropped_lines: DataFrame
    added_mentions: DataFrame
    dropped_mentions: DataFrame


def _extremes(typed: DataFrame) -> DataFrame:
    return typed.groupBy(DOC).agg(F.min(SALES).alias("min_sales"), F.max(SALES).alias("max_sales"), F.min("OpenDate").alias("min_open"),
                                  F.min("ContractStart").alias("min_start"), F.max("ContractEnd").alias("max_end"))


def _lines(lines: DataFrame) -> DataFrame:
    return _typed_lines(lines).where(F.col(DOC).isNotNull())


def _counts(lines: DataFrame, mentions: DataFrame) -> DataFrame:
    """Signed sums and counts per document; both inputs have ``sign``."""
    money = lines.select(DOC, (F.coalesce(SALES, F.lit(0)) * F.col("sign")).cast("decimal(38,6)").alias("sales"), F.col("sign").alias("n_lines"),
                         F.when(F.col(SALES).isNotNull(), F.col("sign")).otherwise(0).alias("n_sales"), F.lit(0).alias("n_calls"))
    named = mentions.where(F.col(DOC).isNotNull()).select(
        DOC, F.lit(0).cast("decimal(38,6)").alias("sales"), F.lit(0).alias("n_lines"), F.lit(0).alias("n_sales"), F.col("sign").alias("n_calls"))
    return money.unionByName(named).groupBy(DOC).agg(
        F.sum("sales").cast("decimal(38,6)").alias("sales"), *[F.sum(c).cast("bigint").alias(c) for c in _COUNTS[1:]])


def _with_flags(rows: DataFrame, typed: DataFrame) -> DataFrame:
    """``rows`` with ``doc_sales`` (null without sales) and ``doc_flags``."""
    stats = materialize(rows.withColumn("doc_sales", F.when(F.col("n_sales") > 0, F.col("sales"))), "revenue-documents")
    flag = _on_contract(F.col("min_open"), F.col("min_start"), F.col("max_end"))
    flags = materialize(_flags_of(typed, stats, flag).select(F.col(DOC).alias("_doc"), F.col("doc_flags").cast("bigint").alias("doc_flags")), "revenue-flags")
    return stats.join(flags, F.col(DOC) == F.col("_doc"), "left").drop("_doc")


def document_table(numbers: DataFrame, lines: DataFrame) -> DataFrame:
    """The document state from scratch."""
    one, typed = F.lit(1).alias("sign"), _lines(lines)
    counts = _counts(typed.select("*", one), numbers.select(DOC, one))
    return _with_flags(counts.join(_extremes(typed), DOC, "left"), typed)


def credit_calls(mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """The call state: what the calls of ``mentions`` get from the documents."""
    return (mentions.select(CALL, DOC).join(documents.select(DOC, "doc_sales", "doc_flags"), DOC, "left")
            .groupBy(CALL)
            .agg(F.concat_ws(", ", F.array_sort(F.collect_set(DOC))).alias(DOC), F.sum("doc_sales").cast("double").alias(SALES),
                 F.coalesce(F.sum("doc_flags"), F.lit(0)).cast("bigint").alias("OnContract"))
            .withColumn("SalesType", sales_type(F.col(DOC))))


def update_documents(documents: DataFrame, lines: DataFrame, changes: Changes) -> tuple[DataFrame, DataFrame]:
    """The document state after ``changes`` and the documents it concerns;
    ``lines`` are the invoice lines after them."""
    plus, minus = F.lit(1).alias("sign"), F.lit(-1).alias("sign")
    added, dropped = _lines(changes.added_lines), _lines(changes.dropped_lines)
    delta = materialize(_counts(added.select("*", plus).unionByName(dropped.select("*", minus)),
                                changes.added_mentions.select(DOC, plus).unionByName(changes.dropped_mentions.select(DOC, minus))), "revenue-delta")
    touched = delta.select(DOC)
    own = materialize(_lines(lines).join(touched, DOC, "left_semi"), "revenue-lines")
    old = documents.join(touched, DOC, "left_semi")
    lost = materialize(dropped.select(DOC).distinct(), "revenue-lost")
    # extremes: anew where a line went, else against the added lines
    kept = old.join(lost, DOC, "left_anti").select(DOC, *_FIRST, *_LAST).unionByName(_extremes(added).join(lost, DOC, "left_anti").select(DOC, *_FIRST, *_LAST))
    kept = kept.groupBy(DOC).agg(*[F.min(c).alias(c) for c in _FIRST], *[F.max(c).alias(c) for c in _LAST])
    extremes = kept.unionByName(_extremes(own.join(lost, DOC, "left_semi")))
    counts = old.select(DOC, *_COUNTS).unionByName(delta.select(DOC, *_COUNTS)).groupBy(DOC).agg(
        F.sum("sales").cast("decimal(38,6)").alias("sales"), *[F.sum(c).alias(c) for c in _COUNTS[1:]])
    rows = counts.where((F.col("n_lines") > 0) | (F.col("n_calls") > 0)).join(extremes, DOC, "left")
    fresh = _with_flags(rows, own)
    return documents.join(touched, DOC, "left_anti").unionByName(fresh.select(*documents.columns)), touched


def update_calls(calls: DataFrame, documents: DataFrame, mentions: DataFrame, touched: DataFrame, changes: Changes) -> DataFrame:
    """The call state after ``changes``; ``documents`` and ``mentions`` are
    those after them.  A call without mentions left has no row."""
    concerned = (mentions.join(touched, DOC, "left_semi").select(CALL).unionByName(changes.added_mentions.select(CALL))
                 .unionByName(changes.dropped_mentions.select(CALL)).distinct().withColumnRenamed(CALL, "_call"))
    concerned = materialize(concerned, "revenue-calls")
    same = F.col(CALL).eqNullSafe(F.col("_call"))
    fresh = credit_calls(mentions.join(concerned, same, "left_semi"), documents)
    return calls.join(concerned, same, "left_anti").unionByName(fresh.select(*calls.columns))
