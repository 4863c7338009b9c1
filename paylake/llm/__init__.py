"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries and their SQL, and ``__spark_entry__.py`` adds them only when the
subpackage is there.
"""
