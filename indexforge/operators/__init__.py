"""Relational operators of the index jobs (all DataFrame built-ins)."""
