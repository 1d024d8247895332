"""Readers, artifact tables and model providers."""
