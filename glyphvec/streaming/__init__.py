"""Cleaning and embedding over unbounded inputs."""
