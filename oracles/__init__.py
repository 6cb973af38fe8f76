"""DuckDB text of every checked query. Written independently of the Spark code; only fixed reference data is shared."""
