"""accesslens: access-log analytics as PySpark DataFrame jobs."""
