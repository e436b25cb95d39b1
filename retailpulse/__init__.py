"""retailpulse: retail demand / search analytics as composable Spark DataFrame operators.

Layout:
  functions/  Column expressions (text normalization, dates, numbers, schema helpers)
  sources/    readers and writers (CSV drops, interest exports, landed JSON, sinks)
  operators/  DataFrame -> DataFrame marts (sales, web, dictionary, signals, radar, ...)
  plans/      adapters from the benchmark tables and the registry of runnable queries
  streaming/  incremental daily web facts on Structured Streaming
"""

__version__ = "0.1.0"
