"""Streaming forms of the operators, sinks and state access."""
