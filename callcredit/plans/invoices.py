"""Invoice lines (B2): parts invoices and work-order part lines, one schema.

Output: ``RootDocumentNumber, OpenDate, PartSales, ContractStart,
ContractEnd`` - one row per invoice (or work-order line) and contract of the
machine it was for.  Several contracts on one machine repeat the line; that
fan-out is part of the published definition (D-25).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# --- fixed values -------------------------------------------------------------
PARTS_INVOICE_TYPES = ("P", "C")
HEADER_DOC_PATTERNS = ("__C%", "__R%")      # third character C or R
WORKORDER_DOC_PATTERN = "__S%"              # third character S
ROOT_LENGTH = 9
# --- end of fixed values ------------------------------------------------------

SOURCE = "SourceKey"            # where a line came from: I + invoice or W + work order
SALES = "decimal(28,6)"         # the source's scale; rounding is left to the reports


def _invoice_key() -> Column:
    return F.concat(F.lit("I"), F.col("InvoiceNumber").cast("string")).alias(SOURCE)


def _order_key() -> Column:
    return F.concat(F.lit("W"), F.col("WONo").cast("string")).alias(SOURCE)


def source_keys(invoice_header: DataFrame, workorder_partdetail: DataFrame) -> DataFrame:
    """The keys of all source rows that can give lines."""
    return invoice_header.select(_invoice_key()).unionByName(workorder_partdetail.select(_order_key())).distinct()


def machine_contracts(equipment: DataFrame, conditionsummary: DataFrame) -> DataFrame:
    """equipment LEFT JOIN contracts, keyed by (make, serial).

    ``a LEFT JOIN e ON k LEFT JOIN c ON e.id = c.id`` equals
    ``a LEFT JOIN (e LEFT JOIN c) ON k``, so both invoice branches share this
    one dimension (and its exchange).
    """
    return (equipment.select("EquipmentId", "OriginalMakeCode", "OriginalSerialNumber")
            .join(conditionsummary.select("EquipmentId", "ContractStart", "ContractEnd"),
                  "EquipmentId", "left")
            .select(F.col("OriginalMakeCode").alias("_make"),
                    F.col("OriginalSerialNumber").alias("_serial"),
                    F.to_date("ContractStart").alias("ContractStart"),
                    F.to_date("ContractEnd").alias("ContractEnd")))


def _with_contracts(df: DataFrame, contracts: DataFrame, make: str, serial: str) -> DataFrame:
    cond = (F.col(make) == F.col("_make")) & (F.col(serial) == F.col("_serial"))
    return df.join(contracts, cond, "left")


def build_invoice_lines(invoice_header: DataFrame, workorder_header: DataFrame,
                        workorder_partdetail: DataFrame, equipment: DataFrame,
                        conditionsummary: DataFrame, keep_source: bool = False) -> DataFrame:
    """B2; ``keep_source`` adds the column ``SourceKey``, by which
    :func:`update_invoice_lines` replaces lines."""
    contracts = machine_contracts(equipment, conditionsummary)
    doc = F.col("DocumentNumber")
    header_doc_ok = doc.like(HEADER_DOC_PATTERNS[0]) | doc.like(HEADER_DOC_PATTERNS[1])
    invoices = (invoice_header
                .where(F.col("InvoiceType").isin(*PARTS_INVOICE_TYPES) & header_doc_ok)
                .select("DocumentNumber", "OpenDate", "TotalParts", "Make", "SerialNumber", _invoice_key()))
    from_invoices = (_with_contracts(invoices, contracts, "Make", "SerialNumber")
                     .select(F.left(doc, F.lit(ROOT_LENGTH)).alias("RootDocumentNumber"),
                             F.to_date("OpenDate").alias("OpenDate"),
                             F.col("TotalParts").cast(SALES).alias("PartSales"),
                             "ContractStart", "ContractEnd", SOURCE))

    details = (workorder_partdetail
               .where(F.col("HdrSegInvoiceIndicator").isNull()
                      & F.col("RefDocumentNo").like(WORKORDER_DOC_PATTERN))
               .select("WONo", "RefDocumentNo", "UnitSell", "InvoiceQty", _order_key()))
    headers = workorder_header.select("WONo", "OpenDate", "EquipManufCode", "SerialNo")
    from_workorders = (_with_contracts(details.join(headers, "WONo"), contracts,
                                       "EquipManufCode", "SerialNo")
                       .select(F.left(F.col("RefDocumentNo"), F.lit(ROOT_LENGTH))
                               .alias("RootDocumentNumber"),
                               # D-12: both branches give a date
                               F.to_date("OpenDate").alias("OpenDate"),
                               (F.col("UnitSell") * F.col("InvoiceQty")).cast(SALES)
                               .alias("PartSales"),
                               "ContractStart", "ContractEnd", SOURCE))
    lines = from_invoices.unionByName(from_workorders)
    return lines if keep_source else lines.drop(SOURCE)


def affected_keys(invoice_header: DataFrame, workorder_header: DataFrame,
                  workorder_partdetail: DataFrame, changed: Column) -> DataFrame:
    """Keys of source rows for which ``changed`` holds (e.g. a load-time
    window on ``ETLTimestamp``): invoices, work-order lines, and changed
    work-order headers.  Distinct keys only."""
    return (invoice_header.where(changed).select(_invoice_key())
            .unionByName(workorder_partdetail.where(changed).select(_order_key()))
            .unionByName(workorder_header.where(changed).select(_order_key())).distinct())


def update_invoice_lines(current: DataFrame, invoice_header: DataFrame, workorder_header: DataFrame,
                         workorder_partdetail: DataFrame, equipment: DataFrame,
                         conditionsummary: DataFrame, changed: Column, gone: DataFrame | None = None) -> DataFrame:
    """The invoice-line table (built with ``keep_source``) after source
    changes, without a full rebuild.

    Lines are replaced per source key: all lines of the changed invoices and
    work orders, and of those in ``gone`` (``SourceKey``s whose rows were
    dropped), are rebuilt from what the sources hold now; the rest is kept.
    A row that now names another document, became void or went away takes its
    old lines with it.  Changes to equipment or contracts touch unknown keys
    and need a full build.
    """
    keys = affected_keys(invoice_header, workorder_header, workorder_partdetail, changed)
    if gone is not None:
        keys = keys.unionByName(gone.select(SOURCE)).distinct()
    keys = materialize(keys, "invoice-keys")
    headers = invoice_header.join(keys, _invoice_key() == keys[SOURCE], "left_semi")
    details = workorder_partdetail.join(keys, _order_key() == keys[SOURCE], "left_semi")
    orders = workorder_header.join(keys, _order_key() == keys[SOURCE], "left_semi")
    fresh = build_invoice_lines(headers, orders, details, equipment, conditionsummary, keep_source=True)
    kept = current.join(keys, SOURCE, "left_anti").select(*current.columns)
    return kept.unionByName(fresh)
