"""Cleaning and analysis of public loan extracts on Spark."""
