"""Operators for preparing training data: the ten of `queries.py`, and the helpers they share."""
