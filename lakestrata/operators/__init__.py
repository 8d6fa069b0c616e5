"""Per-step transformations: bronze, merge, silver, diagnosis, gold, type inventory."""
