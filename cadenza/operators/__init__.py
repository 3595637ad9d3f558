"""Relational operators of the speech quality engine."""
