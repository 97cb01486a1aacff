"""Whole jobs and the registry of named queries."""
