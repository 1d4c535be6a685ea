"""Commands and alerts, on streams and on tables."""
