"""shelfline: retail analytics (ingest, clean, marts, upsert, history, checks)
expressed as Spark DataFrame jobs over Parquet."""

__version__ = "0.1.0"
