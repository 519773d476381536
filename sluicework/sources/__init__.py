"""Readers, writers and the store they work on."""
