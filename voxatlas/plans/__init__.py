"""Configurations, project layouts and the staged pipeline."""
