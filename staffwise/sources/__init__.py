"""Readers, writers, explicit schemas and bindings to the shared tables."""
