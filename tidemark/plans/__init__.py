"""Table store, control tables, monitoring reports and sync flows."""
