"""Whole plans: the daily pipeline and the registered queries with their SQL checks."""
