"""Readers, writers and the fixed schema of every stage."""
