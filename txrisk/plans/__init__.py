"""Whole runs over one set of input tables."""
