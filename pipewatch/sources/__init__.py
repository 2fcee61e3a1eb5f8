"""Readers and the logical inputs derived from the driver tables."""
