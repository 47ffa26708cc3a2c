"""Tessarium plans."""
