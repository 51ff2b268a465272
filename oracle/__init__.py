"""Independent DuckDB statements for every registered job (the correctness
oracle), with the fixture views written again in SQL."""
