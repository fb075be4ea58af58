"""Scans, stream sources and sinks."""
