"""Column expressions: rules, features, statistics."""
