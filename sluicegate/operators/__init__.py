"""DataFrame operators: schema, clean-up, checks and reports."""
