"""Whole queries and pipelines over the league tables."""
