"""Incremental pick-up of delivered files."""
