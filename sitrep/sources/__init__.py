"""Readers and the parsing of landed payloads."""
