"""Column expressions: cleaning, scoring and display."""
