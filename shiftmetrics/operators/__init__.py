"""Reusable relational building blocks for shift analytics."""
