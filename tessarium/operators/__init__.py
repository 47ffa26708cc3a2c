"""Tessarium operators."""
