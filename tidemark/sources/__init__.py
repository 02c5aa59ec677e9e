"""Readers of landed provider payloads, and table writers."""
