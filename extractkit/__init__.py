"""Spark jobs for the data side of structured-extraction models."""
