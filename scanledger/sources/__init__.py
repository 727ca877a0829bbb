"""Readers and writers; every schema is explicit."""
