"""Runs over pages as they arrive."""
