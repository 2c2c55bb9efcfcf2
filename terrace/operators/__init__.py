"""DataFrame operators: one row per key, keys, history, upsert, checks."""
