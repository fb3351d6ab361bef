"""Continuous input: page snapshots that keep arriving in a folder."""
