"""Tessarium functions."""
