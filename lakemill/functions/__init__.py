"""Column -> Column expressions: cleaning, parsing, banding, hashing, rules."""
