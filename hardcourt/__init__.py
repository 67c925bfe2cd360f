"""Play-by-play analytics and statistics tables as Spark DataFrame jobs."""
