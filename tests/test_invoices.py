from pyspark.sql import functions as F

from callcredit.plans import bindings as b
from callcredit.plans.invoices import build_invoice_lines, source_keys, update_invoice_lines
from conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_incremental_update_equals_full_build_and_is_idempotent(spark):
    t = {n: b.read(spark, SF_SMALL, n) for n in ("orders", "lineitem", "part", "supplier")}
    src = b.invoice_sources(t["orders"], t["lineitem"], t["part"], t["supplier"])
    cutoff = F.lit("1999-01-01 00:00:00")
    before = {k: (v.where(F.col("ETLTimestamp") < cutoff) if "ETLTimestamp" in v.columns else v)
              for k, v in src.items()}
    old = build_invoice_lines(**before, keep_source=True).cache()
    full = _rows(build_invoice_lines(**src, keep_source=True))
    assert _rows(old) != full
    changed = F.col("ETLTimestamp") >= cutoff
    once = update_invoice_lines(old, changed=changed, **src).cache()
    assert _rows(once) == full
    # a second pass with the same window replaces the same documents again
    assert _rows(update_invoice_lines(once, changed=changed, **src)) == full


def test_update_follows_key_changes_and_deletions(spark):
    """An invoice that now names another document, one that is void, and one
    that is gone take their old lines with them."""
    t = {n: b.read(spark, SF_SMALL, n) for n in ("orders", "lineitem", "part", "supplier")}
    src = b.invoice_sources(t["orders"], t["lineitem"], t["part"], t["supplier"])
    old = build_invoice_lines(**src, keep_source=True).cache()
    key = F.col("InvoiceNumber").cast("bigint")
    changed = dict(src)
    changed["invoice_header"] = src["invoice_header"].where(key % 7 != 0).withColumn(
        "DocumentNumber", F.when(key % 5 == 0, F.lit("99C999999-X")).otherwise(F.col("DocumentNumber"))).withColumn(
        "InvoiceType", F.when(key % 11 == 0, F.lit("W")).otherwise(F.col("InvoiceType"))).withColumn(
        "ETLTimestamp", F.when((key % 5 == 0) | (key % 11 == 0), F.lit("2030-01-01").cast("timestamp_ntz")).otherwise(F.col("ETLTimestamp")))
    gone = old.select("SourceKey").subtract(source_keys(changed["invoice_header"], changed["workorder_partdetail"]))
    out = update_invoice_lines(old, changed=F.col("ETLTimestamp") >= F.lit("2030-01-01"), gone=gone, **changed)
    assert _rows(out) == _rows(build_invoice_lines(**changed, keep_source=True))


def test_invoice_fixture_rows(spark):
    from datetime import datetime
    from decimal import Decimal
    headers = spark.createDataFrame([
        ("I1", "00C000001-A", datetime(2020, 1, 5, 10), Decimal("10.00"), "CAT", "S1", "P"),
        ("I2", "00R000002", datetime(2020, 1, 6), Decimal("20.00"), "CAT", "S9", "C"),
        ("I3", "00S000003", datetime(2020, 1, 7), Decimal("30.00"), "CAT", "S1", "P"),   # S: not an invoice doc
        ("I4", "00C000004", datetime(2020, 1, 8), Decimal("40.00"), "CAT", "S1", "X"),   # type filtered out
    ], "InvoiceNumber string, DocumentNumber string, OpenDate timestamp_ntz, TotalParts decimal(18,2), "
       "Make string, SerialNumber string, InvoiceType string")
    wo_headers = spark.createDataFrame([("W1", datetime(2020, 2, 1, 8), "CAT", "S1")],
                                       "WONo string, OpenDate timestamp_ntz, EquipManufCode string, SerialNo string")
    wo_lines = spark.createDataFrame([
        ("W1", "1", "P1", 1, "01S000010/1", Decimal("2.50"), 4, None),
        ("W1", "1", "P2", 2, "01S000010/2", Decimal("1.00"), 1, "Y"),     # invoiced with the header: skipped
        ("W1", "2", "P3", 3, "01C000011/1", Decimal("9.00"), 1, None),    # not an S document: skipped
    ], "WONo string, SegmentNo string, PartNo string, SeqNo int, RefDocumentNo string, UnitSell decimal(18,2), "
       "InvoiceQty int, HdrSegInvoiceIndicator string")
    equipment = spark.createDataFrame([(1, "CAT", "S1")], "EquipmentId bigint, OriginalMakeCode string, "
                                                          "OriginalSerialNumber string")
    contracts = spark.createDataFrame([(1, datetime(2019, 1, 1), datetime(2021, 1, 1)),
                                       (1, datetime(2015, 1, 1), datetime(2016, 1, 1))],
                                      "EquipmentId bigint, ContractStart timestamp_ntz, ContractEnd timestamp_ntz")
    out = build_invoice_lines(headers, wo_headers, wo_lines, equipment, contracts)
    assert dict(out.dtypes)["OpenDate"] == "date"    # both branches give dates (D-12)
    rows = sorted((r.RootDocumentNumber, str(r.OpenDate), float(r.PartSales), str(r.ContractStart))
                  for r in out.collect())
    # two contracts on the machine repeat its lines (D-25); no equipment -> no contract
    assert rows == [("00C000001", "2020-01-05", 10.0, "2015-01-01"), ("00C000001", "2020-01-05", 10.0, "2019-01-01"),
                    ("00R000002", "2020-01-06", 20.0, "None"),
                    ("01S000010", "2020-02-01", 10.0, "2015-01-01"), ("01S000010", "2020-02-01", 10.0, "2019-01-01")]
