"""Lifecycle of documents, in batch and in streams."""
