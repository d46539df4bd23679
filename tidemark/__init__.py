"""Time-bucket ingestion and serving on PySpark."""

from tidemark.settings import LoadSettings

__all__ = ["LoadSettings"]
