"""Business rules as Spark column expressions; no Python runs per row."""
