"""Bounded and streaming inputs."""
