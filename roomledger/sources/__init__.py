"""Readers: text and JSON files, JDBC tables, stored tables."""
