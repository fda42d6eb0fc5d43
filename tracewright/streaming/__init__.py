"""Subpackage of tracewright: streaming."""
