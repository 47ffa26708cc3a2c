"""Tessarium sources."""
