"""Operators for preparing training text: one module for each, queries and pipeline stages beside them."""
