"""Readers, writers and report rendering."""
