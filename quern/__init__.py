"""Document-search and analytics operators as Spark DataFrame jobs."""
