"""Jobs over tables: the lakehouse tables, the daily batch, the CLI, the checked queries."""
