"""Whole queries: pipeline models, dashboard panels, data-quality checks."""
