"""Relational and per-group operators."""
