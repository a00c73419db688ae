"""tessera: gridded population -> multi-resolution hexagonal cell index, on Spark.

Layout:
  functions/  Column expressions: cell system, numeric rules, WKB points, H3 adapter
  sources/    pixel / tile / index readers, grid layer, catalog, layout audit
  operators/  mask, multi-resolution index, analytics, raster inspection
  sinks/      sorted partitioned Parquet, metadata JSON, run manifest
  plans/      the index-build job, registered queries and their SQL oracle
  streaming/  resumable window-batch processing on Structured Streaming
"""

__version__ = "0.1.0"
