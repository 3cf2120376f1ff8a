"""Scans, sinks and stored artifacts."""
