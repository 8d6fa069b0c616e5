"""Column expressions shared by the steps (value classes, severity, flag rule)."""
