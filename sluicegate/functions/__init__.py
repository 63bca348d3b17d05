"""Column builders: text, casts, patterns, predicates, clean-ups and checks."""
