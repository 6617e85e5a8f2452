"""Panel analytics for ranked events, as Spark DataFrame jobs."""
