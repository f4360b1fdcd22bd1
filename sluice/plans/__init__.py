"""Whole steps: staging, curation, monitoring and the full run."""
