"""Relational and array operators over frame-indexed tracks."""
