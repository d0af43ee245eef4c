"""Composite jobs, test views and the query catalogue."""
