"""Composite models: bronze loads, silver and gold tables, the daily run."""
