"""Serving tables, dashboard panels and the named query catalogue."""
