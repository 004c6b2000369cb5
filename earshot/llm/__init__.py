"""Operators for preparing training text, and the queries and pipeline built from them."""
