"""Business-registry analytics as PySpark DataFrame jobs."""
