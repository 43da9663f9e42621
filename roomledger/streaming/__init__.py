"""Streams: JSON intervals into Bronze, Bronze into Silver."""
