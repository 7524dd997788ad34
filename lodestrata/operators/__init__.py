"""Relational operators of the archive engine."""
