"""Symbol-usage analytics over large collections of short posts, written as Spark DataFrame jobs."""
