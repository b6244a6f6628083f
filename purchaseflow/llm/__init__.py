"""Operators for preparing text corpora: one module per operator, their queries in queries."""
