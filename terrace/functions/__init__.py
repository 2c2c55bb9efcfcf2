"""Column expressions: text cleanup, tolerant conversion, measures."""
