"""Whole jobs: loading, evaluating, coverage, reports."""
