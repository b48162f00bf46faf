"""Station analytics for shared-bike networks, written as Spark DataFrame jobs."""
