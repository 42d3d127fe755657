"""Queries on the driver's tables, each with the SQL of the same rows."""
