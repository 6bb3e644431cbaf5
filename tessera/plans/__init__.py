"""Composite queries (hub + product + read queries) built from the operators."""
