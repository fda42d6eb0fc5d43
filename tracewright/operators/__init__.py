"""Subpackage of tracewright: operators."""
