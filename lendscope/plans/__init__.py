"""Whole jobs made of the operators (H1-H6)."""
