"""millrace: continuous ingestion into evolving tables, and preparation of large corpora, on PySpark."""

__version__ = "0.1.0"
