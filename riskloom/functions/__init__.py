"""Column expressions: features, ensemble arithmetic, alert fields."""
