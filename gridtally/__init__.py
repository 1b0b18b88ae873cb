"""gridtally: grid coverage and KPI analytics for located event records on Spark.

Every public function takes and returns DataFrames (or Columns) and only
declares a plan; Catalyst and AQE choose the physical strategy. Modules:

- ``gridtally.functions``: Column expressions (MGRS grid ids, casts, tags,
  clock text, whitespace tokens, weekly date windows).
- ``gridtally.operators``: DataFrame operators (top-N + others coverage, grid
  KPI aggregate, access bursts, id reconciliation, freshness and gaps,
  sampling and profiling).
- ``gridtally.sources``: the call-record schema, day-partitioned CSV scans,
  JSON alert records, Parquet / CSV / gzip CSV sinks.
- ``gridtally.plans``: whole jobs and session settings.
"""
