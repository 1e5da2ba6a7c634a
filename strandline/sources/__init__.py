"""Readers, writers and verified snapshots."""
