"""DuckDB oracle SQL for every registered query (correctness gate).

Written from the survey's definitions in the reference's own shape (separate
queries per measure, joins, UNION ALL) so it does not repeat the one-pass
Spark plans."""
