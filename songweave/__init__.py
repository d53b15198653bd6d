"""Recommendation analytics on interaction logs, expressed as Spark DataFrame jobs."""
