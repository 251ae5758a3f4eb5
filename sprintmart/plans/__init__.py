"""Extracts, staging tables, publishing and the nightly run."""
