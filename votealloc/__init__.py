"""votealloc: election-results analytics as Spark DataFrame jobs."""
