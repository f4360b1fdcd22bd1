"""Rules and their evaluation, scoring, deduplication, quarantine, keys."""
