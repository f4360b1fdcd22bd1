"""Data quality, quarantine and curation of text-typed extracts on Spark."""
