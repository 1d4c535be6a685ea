"""Policy-capped table samples as Spark jobs."""
