"""Exploration queries over calls.

Input ``calls``: one row per call with at least ``MeetingID`` and
``DurationHours`` and the grouping columns a query names (customer, call
type, objective, branch, contact).  ``spend``: one row per customer with
segment labels and expenditure.

Every query is an aggregate first and a small ordering step after.  The
total row of a top-N comes from the same grouping-sets aggregation; a share
of a grand total divides by a scalar subquery (one aggregate row); per-
segment totals are one row per segment column, broadcast.  No global window
over data rows and no cross join.  Top-N uses ``orderBy + limit`` (a top-k
per task, then a merge of k rows per task), always with the grouping keys
as tie-break so the chosen rows are deterministic.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ID = "MeetingID"
HOURS = "DurationHours"
# Sums of already aggregated measures are taken in this decimal type, so a
# share does not depend on the order in which partitions are added.
EXACT = "decimal(38,6)"


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def _min_per_call(hours: Column, calls: Column) -> Column:
    """Minutes per call; NULL when there are no calls."""
    return _ratio(hours, calls) * F.lit(60.0)


def duration_hours(start: Column, saved: Column) -> Column:
    """Hours between two timestamps."""
    return (F.unix_micros(saved.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) \
        / F.lit(3_600_000_000.0)


def _non_null(cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def by_key(calls: DataFrame, keys: list[str]) -> DataFrame:
    """A4 body: per key ``TotalCalls`` (non-null ids), ``TotalHours`` (sum
    of non-null hours, 0 when none) and ``MinPerCall``; NULL keys dropped."""
    return (calls.where(_non_null(keys))
            .groupBy(*keys)
            .agg(F.count(ID).alias("TotalCalls"),
                 F.coalesce(F.sum(HOURS), F.lit(0)).cast("double").alias("TotalHours"))
            .withColumn("MinPerCall", _min_per_call(F.col("TotalHours"), F.col("TotalCalls"))))


def _order(sort_by: str, keys: list[str]) -> list[Column]:
    return [F.col(sort_by).desc_nulls_last()] + [F.col(k).asc_nulls_last() for k in keys]


def top_with_total(calls: DataFrame, keys: list[str], top_n: int = 10,
                   sort_by: str = "TotalHours") -> DataFrame:
    """A4 / L1 / L2: the total row (``is_total = true``, keys NULL) plus the
    ``top_n`` keys by ``sort_by``.

    One scan: ``GROUPING SETS ((keys), ())`` gives the per-key rows and the
    total in a single aggregation (each with its own measure: the total
    counts only calls with both an id and hours), and one top-k keeps the
    total first and the ``top_n`` largest keys after it.  With no calls at
    all the result is empty.
    """
    if sort_by not in ("TotalHours", "TotalCalls"):
        raise ValueError("sort_by must be TotalHours or TotalCalls")
    both = F.col(ID).isNotNull() & F.col(HOURS).isNotNull()
    rows = (calls.where(_non_null(keys))
            .groupingSets([keys, []], *keys)
            .agg(F.count(ID).alias("_calls"),
                 F.coalesce(F.sum(HOURS), F.lit(0)).alias("_hours"),
                 F.count(F.when(both, F.lit(1))).alias("_total_calls"),
                 F.coalesce(F.sum(F.when(both, F.col(HOURS))), F.lit(0)).alias("_total_hours"),
                 F.grouping_id().alias("_gid")))
    is_total = F.col("_gid") > 0
    out = rows.select(*keys,
                      F.when(is_total, F.col("_total_calls")).otherwise(F.col("_calls")).alias("TotalCalls"),
                      F.when(is_total, F.col("_total_hours")).otherwise(F.col("_hours"))
                      .cast("double").alias("TotalHours"),
                      is_total.alias("is_total"))
    out = out.withColumn("MinPerCall", _min_per_call(F.col("TotalHours"), F.col("TotalCalls")))
    return (out.orderBy(F.col("is_total").desc(), *_order(sort_by, keys)).limit(top_n + 1)
            .select(*keys, "TotalCalls", "TotalHours", "MinPerCall", "is_total"))


def all_but_total(calls: DataFrame, keys: list[str]) -> DataFrame:
    """L3: every key row, no total row."""
    return by_key(calls, keys)


def top_measures_sum(calls: DataFrame, keys: list[str], top_n: int = 10,
                     sort_by: str = "TotalHours") -> DataFrame:
    """Column sums over the ``top_n`` rows (total row excluded)."""
    top = by_key(calls, keys).orderBy(*_order(sort_by, keys)).limit(top_n)
    return top.agg(F.sum("TotalCalls").alias("TotalCalls"),
                   F.sum(F.col("TotalHours").cast(EXACT)).cast("double").alias("TotalHours"),
                   F.sum(F.col("MinPerCall").cast("decimal(38,10)")).cast("double").alias("MinPerCall"))


def pivot_with_totals(calls: DataFrame, keys: list[str], pivot_col: str, values: list[str],
                      top_n: int = 10) -> DataFrame:
    """A5: call counts per key x pivot value, a ``Total`` column, the
    ``top_n`` keys by total and the total row.

    The pivot values are given, so no job runs to find them; every column
    comes from one aggregation pass, and the total row is the column sums
    of the per-key rows (each counts calls with a key, a pivot value and an
    id, exactly the calls the total row counts).
    """
    names = {v: re.sub(r"\W+", "_", v) for v in values}
    counts = [F.count(F.when(F.col(pivot_col) == v, F.col(ID))).alias(names[v]) for v in values]
    per_key = (calls.where(_non_null(keys)).groupBy(*keys)
               .agg(*counts, F.count(F.when(F.col(pivot_col).isNotNull(), F.col(ID))).alias("Total")))
    top = per_key.orderBy(*_order("Total", keys)).limit(top_n)
    cols = [names[v] for v in values] + ["Total"]
    total = per_key.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols]).select(
        *[F.lit(None).cast(calls.schema[k].dataType).alias(k) for k in keys], *cols)
    return (total.withColumn("is_total", F.lit(True))
            .unionByName(top.withColumn("is_total", F.lit(False))))


def calls_hours(calls: DataFrame, key: str) -> DataFrame:
    """Calls and hours per key."""
    return (calls.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(ID).alias("TotalCalls"), F.coalesce(F.sum(HOURS), F.lit(0)).cast("double")
                 .alias("TotalHours")))


def calls_hours_corr(calls: DataFrame, key: str) -> DataFrame:
    """Correlation between calls and hours across keys."""
    return calls_hours(calls, key).agg(
        F.round(F.corr("TotalCalls", "TotalHours"), 6).alias("corr_calls_hours"))


def pareto(calls: DataFrame, group: list[str], item: str, threshold: float = 85.0) -> DataFrame:
    """Per group, items by hours; share of the group's hours and
    running share (largest first, ties by item); keep running share <=
    ``threshold`` (the row crossing it is dropped).

    The window is partitioned by group over the already aggregated
    (group, item) rows.
    """
    per_item = (calls.where(_non_null(group + [item])).groupBy(*group, item)
                .agg(F.coalesce(F.sum(HOURS), F.lit(0)).alias("_h")))
    whole = Window.partitionBy(*group)
    running = whole.orderBy(F.col("_h").desc(), F.col(item).asc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    total = F.sum("_h").over(whole)
    return (per_item
            .withColumn("PctTotal", _ratio(F.col("_h"), total) * F.lit(100.0))
            .withColumn("PctTotalCumSum", _ratio(F.sum("_h").over(running), total) * F.lit(100.0))
            .where(F.col("PctTotalCumSum") <= F.lit(threshold))
            .select(*group, item, F.col("_h").cast("double").alias("TotalHours"), "PctTotal",
                    "PctTotalCumSum"))


def ordered_counts(df: DataFrame, groups: list[str], col: str, descending: bool = False,
                   partitions: int | None = None) -> DataFrame:
    """Distinct values of ``col`` per group with their row count ``_n`` and
    ``_before``, the number of rows of the group that come earlier in the
    order - the building block of ranks and exact quantiles, computed
    without a global window and without holding any group in one task:

    1. (group, value) counts - partial aggregation, so a value held by a
       third of the rows costs one row;
    2. range-partitioned by (group, value); the rows of each partition are
       summed per group, and these per-partition sums (at most one row per
       partition and group) are accumulated in partition order;
    3. inside each partition a running count gives the rows before each
       value.
    The range-partitioned counts are written to the shared checkpoint
    folder and read back, so a lost executor does not re-run the sampling of
    the range split.
    """
    from ..session import materialize
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(col).desc() if descending else F.col(col).asc()
    counts = (df.where(F.col(col).isNotNull()).groupBy(*groups, col)
              .agg(F.count(F.lit(1)).alias("_n")))
    ranged = materialize(counts.repartitionByRange(n, *[F.col(g).asc() for g in groups], order)
                         .withColumn("_p", F.spark_partition_id()), "ordered_counts")
    earlier = Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_p", *groups).agg(F.sum("_n").alias("_pn"))
               .withColumn("_off", F.coalesce(F.sum("_pn").over(earlier), F.lit(0)))
               .select("_p", *groups, "_off"))
    if not groups:
        # one row per range partition: its size is bounded by the partition count
        offsets = F.broadcast(offsets)
    within = Window.partitionBy("_p", *groups).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)
    return (ranged.join(offsets, ["_p", *groups])
            .withColumn("_before", F.col("_off") + F.coalesce(F.sum("_n").over(within), F.lit(0)))
            .select(*groups, col, "_n", "_before"))


def average_rank_desc(df: DataFrame, col: str, out: str, partitions: int | None = None) -> DataFrame:
    """Pandas ``rank(ascending=False)`` (ties get the average
    rank) cut to an integer, over the whole table.

    rank(v) = #rows with a larger value + (#rows equal to v + 1) / 2, from
    ``ordered_counts``; the ranks join back to the rows by value.
    """
    ranks = (ordered_counts(df, [], col, descending=True, partitions=partitions)
             .select(col, (F.col("_before") + (F.col("_n") + 1) / 2).cast("int").alias(out)))
    return df.join(ranks, col, "left")


def exact_quantiles(df: DataFrame, group: str, col: str, probs: dict[str, float],
                    partitions: int | None = None) -> DataFrame:
    """Exact quantiles of ``col`` per ``group`` with linear interpolation
    (position ``p * (n - 1)``, as SQL ``percentile_cont``), one column per
    entry of ``probs``.

    Built on ``ordered_counts``: each group's size comes from summing its
    counts; the values at the two positions around each quantile are found
    by their covering [before, before + n) ranges.  No aggregate keeps the
    values of a group, so a group holding most of the rows is handled like
    any other.
    """
    oc = ordered_counts(df, [group], col, partitions=partitions)
    sizes = oc.groupBy(group).agg(F.sum("_n").alias("_size"))
    wanted = [F.struct(F.lit(name).alias("q"), F.lit(float(p)).alias("p")) for name, p in probs.items()]
    targets = (sizes.select(group, "_size", F.explode(F.array(*wanted)).alias("_t"))
               .select(group, "_t.q", (F.col("_t.p") * (F.col("_size") - 1)).alias("_pos"))
               .withColumn("_lo", F.floor("_pos")).withColumn("_hi", F.ceil("_pos")))
    covers = lambda k: (F.col("_before") <= F.col(k)) & (F.col(k) < F.col("_before") + F.col("_n"))
    picked = (oc.join(targets, group)
              .where(covers("_lo") | covers("_hi"))
              .groupBy(group, "q", "_pos", "_lo")
              .agg(F.max(F.when(covers("_lo"), F.col(col))).alias("_vlo"),
                   F.max(F.when(covers("_hi"), F.col(col))).alias("_vhi")))
    value = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * (F.col("_pos") - F.col("_lo"))
    return (picked.groupBy(group)
            .agg(*[F.max(F.when(F.col("q") == name, value)).alias(name) for name in probs]))


def share_of_total(grouped: DataFrame, measure: str, out: str) -> DataFrame:
    """Share in percent of a grouped measure (scalar subquery for the
    total)."""
    total = grouped.agg(F.sum(measure))
    return grouped.withColumn(out, _ratio(F.col(measure) * F.lit(100.0), total.scalar()))


def segment_share(per_customer: DataFrame, segments: list[str], measure: str = "TotalHours",
                  top_n: int = 11) -> DataFrame:
    """Measure per segment combination as a percent of the whole,
    first ``top_n`` rows (no total row)."""
    grouped = (per_customer.where(_non_null(segments)).groupBy(*segments)
               .agg(F.sum(F.col(measure).cast(EXACT)).alias("_m")))
    return (share_of_total(grouped, "_m", "PctTotalHours")
            .orderBy(*_order("PctTotalHours", segments)).limit(top_n)
            .select(*segments, "PctTotalHours"))


def segment_share_each(per_customer: DataFrame, segments: list[str],
                       measure: str = "TotalHours") -> DataFrame:
    """For each segment column on its own, the fraction of the measure
    per value and its place, largest first.

    One pass: the segment columns are unpivoted to (segment, value) and
    grouped once; the totals (one row per segment column, so their size is
    known) are broadcast back onto the grouped rows.
    """
    # unpivot the segment columns to (segment, value) rows
    long = (per_customer.select(F.col(measure).cast(EXACT).alias("_m"),
                                *[F.col(s).cast("string").alias(s) for s in segments])
            .unpivot(["_m"], segments, "segment", "value")
            .where(F.col("value").isNotNull()))
    grouped = long.groupBy("segment", "value").agg(F.sum("_m").alias("_m"))
    totals = grouped.groupBy("segment").agg(F.sum("_m").alias("_total"))
    place = Window.partitionBy("segment").orderBy(F.col("_m").desc(), F.col("value").asc())
    return grouped.join(F.broadcast(totals), "segment").select(
        "segment", "value", _ratio(F.col("_m"), F.col("_total")).alias("ShareTotalHours"),
        F.row_number().over(place).alias("Place"))


def segment_distribution(per_customer: DataFrame, segment: str, measure: str = "MinPerCall",
                         approx: bool = False) -> DataFrame:
    """Box-plot numbers of ``measure`` per segment value: quartiles and
    the whiskers (furthest values within 1.5 IQR of the box).

    Quartiles are exact (``exact_quantiles``); ``approx=True`` uses a
    bounded-memory sketch per group instead.
    """
    rows = per_customer.where(F.col(segment).isNotNull() & F.col(measure).isNotNull())
    if approx:
        probs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
        stats = (rows.groupBy(segment).agg(F.percentile_approx(measure, probs, 10000).alias("_q"))
                 .select(segment, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                         F.col("_q")[2].alias("q3")))
    else:
        stats = exact_quantiles(rows, segment, measure, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    lo = F.col("q1") - F.lit(1.5) * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + F.lit(1.5) * (F.col("q3") - F.col("q1"))
    v = F.col(measure)
    whiskers = (rows.join(stats, segment)
                .groupBy(segment, "q1", "median", "q3")
                .agg(F.min(F.when(v >= lo, v)).alias("whisker_low"),
                     F.max(F.when(v <= hi, v)).alias("whisker_high")))
    return whiskers


def spend_per_hour(top: DataFrame, spend: DataFrame, key: str = "CustomerNo") -> DataFrame:
    """The top customers with their spend per hour (NULL without
    hours) and their place by hours, most first.  ``top`` is a top-N list, so
    its window is small."""
    place = Window.orderBy(F.col("TotalHours").desc(), F.col(key).asc())
    return (top.join(spend, key)
            .withColumn("ExpPerHour", F.try_divide(F.col("Expenditure_5YAVG_PartsNServices"), F.col("TotalHours")))
            .withColumn("Place", F.row_number().over(place)).orderBy("Place"))


def sales_by_root(invoices: DataFrame, document: str, sales: str, length: int = 9) -> DataFrame:
    """Sales per root document, the first ``length`` characters."""
    return invoices.groupBy(F.left(document, F.lit(length)).alias("RootPDN")).agg(F.sum(sales).cast("double").alias(sales))


def calls_with_sales(calls: DataFrame, numbers: DataFrame, sales: DataFrame) -> DataFrame:
    """Every call with the distinct numbers it names, their
    sales and the sales type.  The sales are stored first: a document of very
    many calls can be split only when neither side is an aggregate."""
    from .revenue import sales_type
    sales = materialize(sales, "sales-by-root")
    per_call = (numbers.join(sales, numbers["RootDocumentNumber"] == sales["RootPDN"], "left")
                .groupBy("MeetingId")
                .agg(F.concat_ws(", ", F.array_sort(F.collect_set("RootDocumentNumber"))).alias("RootPDN"),
                     F.coalesce(F.sum(F.col("TotalPartSales").cast(EXACT)).cast("double"), F.lit(0.0)).alias("TotalPartSales")))
    return (calls.join(per_call, "MeetingId", "left")
            .select("MeetingId", F.trim("Branch").alias("Branch"), "RootPDN", "TotalPartSales",
                    sales_type(F.col("RootPDN")).alias("SalesType")))


def drill(calls: DataFrame, keys: list[str]) -> DataFrame:
    """Hours, calls and minutes per call per key combination,
    ordered inside the second key by hours (``Place``)."""
    out = (calls.groupBy(*keys)
           .agg(F.coalesce(F.sum(HOURS), F.lit(0)).cast("double").alias("TotalHours"),
                F.count(ID).alias("TotalCalls"))
           .withColumn("MinPerCall", _min_per_call(F.col("TotalHours"), F.col("TotalCalls")))
           .withColumn("Place", F.row_number().over(Window.partitionBy(*keys[:2]).orderBy(
               F.col("TotalHours").desc(), *[F.col(k).asc() for k in keys[2:]]))))
    return out.orderBy(*[F.col(k).asc() for k in keys[:2]], F.col("TotalHours").desc(),
                       *[F.col(k).asc() for k in keys[2:]])


def dedupe_rows(df: DataFrame) -> DataFrame:
    """U7 / D-19: drop repeated rows, the customer key included."""
    return df.distinct()


def clean_names(df: DataFrame, drop_suffix: str | None = None) -> DataFrame:
    """P20: remove non-word characters from column names, then a suffix."""
    new = []
    for c in df.columns:
        n = re.sub(r"\W", "", c)
        if drop_suffix and n.endswith(drop_suffix):
            n = n[: -len(drop_suffix)]
        new.append(n)
    return df.toDF(*new)
