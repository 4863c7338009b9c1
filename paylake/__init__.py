"""paylake — a Spark-native payments lakehouse.

Lake files -> raw transactions -> staged, enriched rows -> a star schema of
one transaction fact and five dimensions -> dashboard panels and data checks.
Every step is a DataFrame -> DataFrame function planned by Catalyst.
"""

__all__ = ["session", "schema"]
