"""Derived inputs, compositions and the query catalogue."""
