"""Readers of the library's inputs."""
