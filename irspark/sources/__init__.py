"""Readers, writers and fixture derivations."""
