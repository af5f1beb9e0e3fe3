"""DuckDB statements that state the expected result of every registered query."""
