"""Scans, sinks and file contracts."""
