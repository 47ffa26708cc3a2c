"""Tessarium streaming."""
