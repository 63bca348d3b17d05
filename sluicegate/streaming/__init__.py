"""The same checks on arriving data."""
