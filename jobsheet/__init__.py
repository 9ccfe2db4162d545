"""jobsheet - order line-item analytics on Spark DataFrames.

Sub-packages:
  sources    - table readers, the order view over the driver tables, JSON
               order ingestion and validation, sinks
  functions  - reusable Column expressions (cleaning, regex, tokenising, stats)
  operators  - DataFrame -> DataFrame operators (features, text, thresholds,
               learners, scoring, metrics, profiling, lifecycle, monitoring)
  plans      - named queries over the driver tables and their SQL oracles
  streaming  - Structured Streaming variants of scoring and monitoring
"""

from jobsheet.config import OrderConfig, body_shop, part_catalog  # noqa: F401
