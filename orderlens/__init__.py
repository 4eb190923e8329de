"""orderlens: order-satisfaction analytics as Spark DataFrame and MLlib operators.

Layout:
  sources/    table schemas, CSV / Parquet / view / model IO, driver-table binding
  functions/  column expressions (epoch seconds, safe ratios, keyed buckets, clipping)
  operators/  review dedupe, feature blocks, quality checks, preparation, encoding,
              training, metrics, scoring, insights
  plans/      the query catalogue and its DuckDB oracle SQL
  streaming/  the batch scorer applied to a stream of feature rows
"""

__version__ = "0.1.0"
