"""Readers, writers and catalog listings."""
