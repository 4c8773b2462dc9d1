"""Readers, writers and code lists."""
