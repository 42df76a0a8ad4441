"""Operators applied to Structured Streaming inputs."""
