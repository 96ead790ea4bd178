"""Readers for raw files and layers, and flight-shaped fixture inputs."""
