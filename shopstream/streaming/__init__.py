"""Structured Streaming forms of the operators and the running pipeline."""
