"""ledgerlens: card-fraud analytics as Spark DataFrame jobs.

Sub-packages:
  sources    readers and writers (text, CSV, Parquet, Kafka, derived test tables)
  functions  column expressions (scorers, hashing, time repair, JSON)
  operators  DataFrame -> DataFrame operators (cleaning, joins, aggregates, evaluation, ML, monitoring)
  streaming  Structured Streaming jobs (parse, score, sinks, progress)
  plans      the registered queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
