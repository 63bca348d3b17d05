"""Whole loads: extract, check, gate, publish, and the way back."""
