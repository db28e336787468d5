"""Column expressions: text, time, numbers, hashes."""
