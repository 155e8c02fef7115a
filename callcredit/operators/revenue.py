"""Revenue attribution: invoice aggregate per document and sales per call.

Inputs
  numbers: one row per (call, document) mention: ``MeetingId``,
           ``RootDocumentNumber``.  Repeats are allowed and count twice.
  lines:   invoice lines: ``RootDocumentNumber``, ``PartSales``, ``OpenDate``,
           ``ContractStart``, ``ContractEnd``.

Published semantics (mode ``strict``)
  joined  = numbers LEFT JOIN lines USING (document)
  per_doc = joined GROUP BY document: sum(sales), min(open), min(start),
            max(end), flag = open BETWEEN start AND end (NULL -> 0)
  joined LEFT JOIN per_doc USING (document, sales, open, start, end)
  GROUP BY call: distinct documents as ", " text, sum(sales), sum(flag)

Because ``per_doc`` sums over the *joined* rows, a document named by ``c``
mentions carries ``c`` times its sales there, and a joined row only picks up
the flag when its own line equals that aggregate on all five columns (plain
equality: NULL never matches).  Mode ``by_document`` aggregates the invoice
lines alone and joins on the document only.

Plan
  The call x line product of the first join is never built: a document named
  by ``c`` calls with ``n`` lines would emit ``c * n`` rows, and a popular
  document would put all of them in one task.  Instead:

  1. per document, from the lines: sum, count, min/min/max    (partial agg)
  2. per document, from the numbers: mention count ``c``       (partial agg)
  3. strict only: count per document ``m`` the lines equal to the
     joined-row aggregate - decided from the aggregates for almost every
     document; the few undecided ones are matched line by line (see
     ``_strict_flags``)
  4. numbers LEFT JOIN per-document result, GROUP BY call       (partial agg)

  The per-document result is stored before it meets the mentions (and, in
  strict mode, before the candidates meet the lines): AQE splits a hot
  document's mentions only when both sides of the join are plain shuffles.

  Sums are taken in decimals that keep six digits of a cent's fraction, so the
  result does not depend on the order of addition, and become double at the
  end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

DOC = "RootDocumentNumber"
SALES = "PartSales"
MONEY = "decimal(38,6)"


def _on_contract(open_col: Column, start: Column, end: Column) -> Column:
    return F.when(open_col.between(start, end), F.lit(1)).otherwise(F.lit(0))


def _typed_lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col(DOC),
        F.col(SALES).cast(MONEY).alias(SALES),
        F.to_date("OpenDate").alias("OpenDate"),
        F.to_date("ContractStart").alias("ContractStart"),
        F.to_date("ContractEnd").alias("ContractEnd"),
    )


def aggregate_invoice(lines: DataFrame) -> DataFrame:
    """A1: sales, first open date, contract span and OnContract per document."""
    typed = _typed_lines(lines)
    return (typed.groupBy(DOC)
            .agg(F.sum(SALES).alias(SALES),
                 F.min("OpenDate").alias("OpenDate"),
                 F.min("ContractStart").alias("ContractStart"),
                 F.max("ContractEnd").alias("ContractEnd"))
            .withColumn("OnContract", _on_contract(F.col("OpenDate"), F.col("ContractStart"),
                                                   F.col("ContractEnd")))
            .withColumn(SALES, F.col(SALES).cast("double")))


def sales_type(doc_list: Column) -> Column:
    """F8: first ``C`` or ``S`` in the document list; NULL when there is none."""
    return F.nullif(F.regexp_extract(doc_list, "([CS])", 0), F.lit(""))


def attribute_revenue(numbers: DataFrame, lines: DataFrame, mode: str = "strict") -> DataFrame:
    """``MeetingId, RootDocumentNumber, PartSales, OnContract, SalesType``."""
    if mode not in ("strict", "by_document"):
        raise ValueError(f"mode must be 'strict' or 'by_document', got {mode!r}")
    typed = _typed_lines(lines).where(F.col(DOC).isNotNull())
    mentions = numbers.select("MeetingId", DOC)

    doc_lines = (typed.groupBy(DOC)
                 .agg(F.sum(SALES).alias("doc_sales"),
                      F.count(F.lit(1)).alias("n_lines"),
                      F.count(SALES).alias("n_sales"),
                      F.min(SALES).alias("min_sales"),
                      F.max(SALES).alias("max_sales"),
                      F.min("OpenDate").alias("min_open"),
                      F.min("ContractStart").alias("min_start"),
                      F.max("ContractEnd").alias("max_end")))
    flag = _on_contract(F.col("min_open"), F.col("min_start"), F.col("max_end"))

    if mode == "by_document":
        # every joined (call, line) row carries its document's flag
        per_doc = doc_lines.select(DOC, "doc_sales", (F.col("n_lines") * flag).alias("doc_flags"))
    else:
        per_doc = _strict_flags(typed, mentions, doc_lines, flag)
    per_doc = materialize(per_doc, "revenue-per-document")

    return (mentions.join(per_doc, DOC, "left")
            .groupBy("MeetingId")
            .agg(F.concat_ws(", ", F.array_sort(F.collect_set(DOC))).alias(DOC),
                 F.sum("doc_sales").cast("double").alias(SALES),
                 F.coalesce(F.sum("doc_flags"), F.lit(0)).cast("bigint").alias("OnContract"))
            .withColumn("SalesType", sales_type(F.col(DOC))))


def _strict_flags(typed: DataFrame, mentions: DataFrame, doc_lines: DataFrame, flag: Column) -> DataFrame:
    """Per mentioned document: its sales and ``n_matched * flag``, where
    ``n_matched`` counts its lines equal, on all five join columns, to the
    aggregate over joined rows (sales ``n_calls * doc_sales``, first open
    date, first contract start, last contract end).

    Most documents are decided by their aggregates alone:
      * one line: it matches iff its sales are present and equal
        ``n_calls`` times themselves (one mention, or zero sales) and its
        three dates are present;
      * two or more present sales all of one sign: ``n_calls * doc_sales``
        is larger (smaller) than every single line, so nothing matches;
      * no present sales: nothing matches.
    Only the rest (several lines with zero or mixed-sign sales) is matched
    line by line.  That set is stored first, so its size is known: when small
    it is broadcast and the invoice lines are probed without a shuffle, else
    the lines of a hot document are split over tasks.
    """
    doc_calls = mentions.where(F.col(DOC).isNotNull()).groupBy(DOC).agg(
        F.count(F.lit(1)).alias("n_calls"))
    return _flags_of(typed, materialize(doc_lines.join(doc_calls, DOC), "revenue-documents"), flag)


def _flags_of(typed: DataFrame, stats: DataFrame, flag: Column) -> DataFrame:
    """``_strict_flags`` from the aggregates of each document."""
    n_calls, sales = F.col("n_calls"), F.col("doc_sales")
    dates_present = (F.col("min_open").isNotNull() & F.col("min_start").isNotNull()
                     & F.col("max_end").isNotNull())
    single = F.col("n_lines") == 1
    one_sign = (F.col("n_sales") >= 2) & ((F.col("min_sales") > 0) | (F.col("max_sales") < 0))
    decided = single | one_sign | (F.col("n_sales") == 0)
    single_match = F.when(single & sales.isNotNull() & ((n_calls == 1) | (sales == 0)) & dates_present,
                          F.lit(1)).otherwise(F.lit(0))
    candidates = materialize(
        stats.where(~decided).select(DOC, (sales * n_calls).alias("t_sales"), "min_open", "min_start", "max_end"),
        "revenue-candidates")
    matched = (typed.join(candidates, DOC)
               .where((F.col(SALES) == F.col("t_sales"))
                      & (F.col("OpenDate") == F.col("min_open"))
                      & (F.col("ContractStart") == F.col("min_start"))
                      & (F.col("ContractEnd") == F.col("max_end")))
               .groupBy(DOC).agg(F.count(F.lit(1)).alias("n_matched")))
    return (stats.join(matched, DOC, "left")
            .select(DOC, "doc_sales",
                    ((single_match + F.coalesce(F.col("n_matched"), F.lit(0))) * flag).alias("doc_flags")))


def attribute_revenue_joined(joined: DataFrame) -> DataFrame:
    """B7 for callers that already hold the joined rows (one per call
    mention and invoice line: ``MeetingId, RootDocumentNumber, PartSales,
    OpenDate, ContractStart, ContractEnd``), as the published function takes
    them.  The per-document aggregate is one row per document, so joining it
    back on the five columns adds no rows."""
    rows = joined.select(
        "MeetingId", F.col(DOC), F.col(SALES).cast(MONEY).alias(SALES),
        F.to_date("OpenDate").alias("OpenDate"), F.to_date("ContractStart").alias("ContractStart"),
        F.to_date("ContractEnd").alias("ContractEnd"))
    per_doc = (rows.groupBy(F.col(DOC).alias("_doc"))
               .agg(F.sum(SALES).alias("_s"), F.min("OpenDate").alias("_o"),
                    F.min("ContractStart").alias("_cs"), F.max("ContractEnd").alias("_ce"))
               .withColumn("_flag", _on_contract(F.col("_o"), F.col("_cs"), F.col("_ce"))))
    cond = ((F.col(DOC) == F.col("_doc")) & (F.col(SALES) == F.col("_s")) & (F.col("OpenDate") == F.col("_o"))
            & (F.col("ContractStart") == F.col("_cs")) & (F.col("ContractEnd") == F.col("_ce")))
    return (rows.join(per_doc, cond, "left")
            .groupBy("MeetingId")
            .agg(F.concat_ws(", ", F.array_sort(F.collect_set(DOC))).alias(DOC),
                 F.sum(SALES).cast("double").alias(SALES),
                 F.coalesce(F.sum("_flag"), F.lit(0)).cast("bigint").alias("OnContract"))
            .withColumn("SalesType", sales_type(F.col(DOC))))
