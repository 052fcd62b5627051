"""Composed jobs: cleaned tables, star schema, models."""
