"""Operators over layout tables, chunks and search rows."""
