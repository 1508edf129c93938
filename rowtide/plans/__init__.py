"""Whole jobs and the registered example queries."""
