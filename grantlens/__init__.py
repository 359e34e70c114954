"""Award, paper and dataset evidence linking as Spark DataFrame jobs."""
