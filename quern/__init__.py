"""quern: bounded and unbounded analytics expressed as Spark DataFrame plans.

Sub-packages:
  sources    readers for tables, literal rows, text, replayed streams
  sinks      batch and streaming writers (idempotent, bucketed, upsert)
  operators  relational helpers that Spark lacks (as-of join, count windows,
             evictors, pattern matching, keyed rolling aggregates, ...)
  functions  scalar functions whose semantics differ from Spark's built-ins
  streaming  Structured Streaming operators (watermarks, windows, state)
  plans      the registered queries, one per operator id, plus SQL oracles
"""

__version__ = "0.1.0"
