"""Data-quality controls and reconciliation as plain Spark DataFrame code."""
