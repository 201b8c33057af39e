"""Refreshing stored tables from streams."""
