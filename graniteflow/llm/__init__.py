"""Operators of a training-data pipeline; their named queries are in ``queries``."""
