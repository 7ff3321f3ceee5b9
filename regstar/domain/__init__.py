"""Rule tables (data only)."""
