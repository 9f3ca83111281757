"""tillwork: retail data pipelines on plain PySpark.

``functions``  column cleaners and validity flags (``str | Column -> Column``)
``operators``  latest row per key, table diff, salted join, masks and row filters
``sources``    feed schemas, incremental file ingest, parquet tables in the catalog
``plans``      table-level transforms, the end-to-end run, the registered queries
``streaming``  click cleaning and low-stock alerts as streams
"""
