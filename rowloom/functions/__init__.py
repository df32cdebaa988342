"""Column builders: random draws, generated values and listing fields."""
