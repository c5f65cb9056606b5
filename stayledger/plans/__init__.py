"""Operators wired together."""
