"""Readers, catalog registration and change-log input."""
