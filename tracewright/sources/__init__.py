"""Subpackage of tracewright: sources."""
