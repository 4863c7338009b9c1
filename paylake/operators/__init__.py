"""Relational building blocks beyond single column expressions."""
