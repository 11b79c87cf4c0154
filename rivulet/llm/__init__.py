"""Operators for preparing training text: search, archives, formatting, scoring, filtering, encoding."""
