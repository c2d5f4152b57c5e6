"""Card-transaction fraud analytics as PySpark jobs."""
