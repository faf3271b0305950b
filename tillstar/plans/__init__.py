"""Whole jobs: the incremental load and the analysis queries."""
