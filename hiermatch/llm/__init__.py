"""Operators for preparing training text; self-contained, nothing else in the library imports it."""
