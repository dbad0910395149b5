"""Scans, sinks and the guards around them."""
