"""Readers (sources) and writers (sinks)."""
