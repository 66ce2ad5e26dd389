"""The batch filters and aggregates on unbounded input."""
