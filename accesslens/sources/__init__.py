"""Scans, dimension loads and sinks."""
