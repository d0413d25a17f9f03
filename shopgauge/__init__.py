"""Manufacturing process-quality analytics as Spark DataFrame jobs."""
