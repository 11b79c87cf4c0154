"""Readers of folders and a stored table with versions."""
