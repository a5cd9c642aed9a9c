"""Whole runs: from raw feeds to marts."""
