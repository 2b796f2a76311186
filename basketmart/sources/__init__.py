"""Readers and writers for the eight source tables."""
