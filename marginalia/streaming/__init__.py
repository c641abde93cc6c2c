"""Structured Streaming forms of the monitoring and scoring operators."""
