"""Operators composed from DataFrame calls: numbering, lookups, loads, checks."""
