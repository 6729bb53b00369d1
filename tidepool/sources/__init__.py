"""Readers for the lake's awkward inputs."""
