"""Layered warehouse building blocks for Spark DataFrames.

Raw text extracts become a typed, checked star schema: scan with lineage,
keep one row per key, upsert, clean, version history, dimensions, fact.
Every function takes DataFrames or Columns and returns DataFrames or Columns.
"""
