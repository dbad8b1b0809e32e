"""Order-and-delivery marketplace analytics as PySpark jobs."""
