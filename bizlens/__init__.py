"""Local-business review analytics as Spark DataFrame jobs."""
