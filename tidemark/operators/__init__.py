"""DataFrame -> DataFrame operators (windows, relational, quality, incremental)."""
