"""Config to plan: policies, requests and row counts of all tables in one query."""
