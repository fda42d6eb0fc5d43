"""Subpackage of tracewright: functions."""
