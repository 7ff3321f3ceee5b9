"""Column -> Column expressions built from Spark built-ins (no UDFs)."""
