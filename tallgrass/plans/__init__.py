"""Composite business jobs built from the operators."""
