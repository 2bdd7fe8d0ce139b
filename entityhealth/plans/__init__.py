"""Whole jobs: what a user calls."""
