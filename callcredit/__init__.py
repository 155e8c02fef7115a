"""callcredit: credit part sales to customer calls, as Spark DataFrame plans.

Layout:
  sources/    readers and writers (files, catalog tables, JDBC, run folders,
              versioned snapshots)
  functions/  column-level building blocks (document-number fold, time zones,
              lookups, classification expressions)
  operators/  DataFrame -> DataFrame operators (upsert / delete, incremental
              windows, member filters, revenue attribution, exploration)
  plans/      table builds that compose operators (call table, invoice lines,
              serving transforms, load runs) and the bindings of the driver's
              test tables to the domain tables
  streaming/  the incremental load expressed as a Structured Streaming query
"""

__version__ = "0.1.0"
