"""Readers, writers and stored fits."""
