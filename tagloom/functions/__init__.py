"""Column expressions and fixed code values shared by the jobs."""
