"""Column expressions over config, catalog and command rows."""
