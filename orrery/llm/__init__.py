"""Operators on text corpora: one module per operator, `queries` applies them to the tables."""
