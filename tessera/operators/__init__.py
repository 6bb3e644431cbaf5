"""DataFrame → DataFrame operators (relational, incremental, quality, nested records)."""
