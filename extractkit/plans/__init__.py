"""Registered queries over the test tables, and the same results as SQL."""
