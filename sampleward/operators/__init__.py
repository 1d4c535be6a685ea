"""Operators on tables: ordering, sampling, writing, copying and refreshing."""
