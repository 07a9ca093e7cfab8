"""Continuous runs of tasks."""
