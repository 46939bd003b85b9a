"""Readers, writers and shared scratch space."""
