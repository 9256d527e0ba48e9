"""worklake — scholarly-works ETL, data quality and reporting on Spark DataFrames.

Layout:
  schema       raw / envelope / stored-table schemas (StructType)
  session      SparkSession defaults and the shared checkpoint folder
  functions/   Column-level helpers (id segments, truthy fallbacks, country sets)
  sources/     JSON landing + export envelope I/O, stored tables, test-data binding
  operators/   flatten, first-wins dedup, upsert merge, run log, data quality, reports
  plans/       named query plans (one per operator key), job entry points
  streaming/   incremental ingest with Structured Streaming (availableNow)
"""

__all__ = ["schema", "session"]
