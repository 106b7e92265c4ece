"""Match-replay analytics as Spark DataFrame jobs."""
