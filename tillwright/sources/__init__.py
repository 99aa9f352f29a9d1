"""Readers, writers, file manifests and table registration."""
