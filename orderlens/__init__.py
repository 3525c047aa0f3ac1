"""orderlens — customer-value analytics expressed as Spark DataFrame plans.

Layers:
  sources/    readers, writers and the driver-table adapter
  functions/  column-expression helpers (money, time parsing, holidays)
  operators/  cleaning, calendar, grain, ranking, CLV, marts, views, quality, profile
  plans/      end-to-end jobs, the registered queries and their SQL oracles
  streaming/  incremental ingest of a landing folder with Structured Streaming
"""

__all__ = ["session"]
