"""Scans, sinks and the healthcare tables derived from the test data."""
