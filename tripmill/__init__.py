"""Urban trip analytics on Spark: ingest, cleanse, load, enrich, marts, KPIs, checks and cost.

Every operator takes and returns DataFrames (or Columns) made of built-in Spark
expressions; there are no Python UDFs.
"""
