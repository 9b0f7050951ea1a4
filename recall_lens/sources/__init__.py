"""Readers for the feeds, the score tables and the test tables."""
