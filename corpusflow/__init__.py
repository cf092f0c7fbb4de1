"""corpusflow: corpus ingestion, incremental indexing and vector search on Spark.

Every operator takes and returns DataFrames (or Columns); nothing is pulled
through the driver. See README.md for the operator map.
"""

__version__ = "0.1.0"
