"""Subpackage of tracewright: plans."""
