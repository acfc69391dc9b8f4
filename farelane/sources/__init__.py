"""Readers and writers of feeds, maps and layers."""
