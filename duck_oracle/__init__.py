"""DuckDB oracle SQL for the registered queries (independent re-statement in SQL)."""
