"""Funding analytics."""
