"""Trip-record analytics as Spark DataFrame jobs."""
