"""Whole comparisons, reports and runs."""
