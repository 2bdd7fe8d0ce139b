"""Scoring of landed files as they arrive."""
