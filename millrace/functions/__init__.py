"""Column expressions: text, hashing, array and time helpers."""
