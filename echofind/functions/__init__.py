"""Column expressions: text cleaning, features, hashing and similarity."""
