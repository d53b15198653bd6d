"""Column expressions: time, weights, hashing and vectors."""
