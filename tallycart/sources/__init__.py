"""Readers, writers and cleaning."""
