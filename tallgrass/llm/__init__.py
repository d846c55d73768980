"""Operators and queries for text training data. Nothing else in the library imports this package."""
