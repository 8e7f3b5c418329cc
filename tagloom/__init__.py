"""Customer activity facts, rule tags, lifecycle and audiences as Spark DataFrame jobs."""
