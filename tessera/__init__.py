"""tessera — batch analytics and incremental table loads written as plain
Spark DataFrame plans.

Sub-packages:
  sources    — parquet file-set scans, changed-file discovery, synthetic tables
  sinks      — writers, versioned publish, create-only writes
  functions  — column-expression helpers (tolerant casts, hash uniforms)
  operators  — quality rules, sales enrichment, aggregations, merge
  plans      — fixture views over the driver tables, jobs, query catalogue
  streaming  — the incremental load as an ``availableNow`` file stream
"""

from tessera.session import create_session, create_tuned_session

__all__ = ["create_session", "create_tuned_session"]
