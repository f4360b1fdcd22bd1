"""Operators that prepare training text: deduplicate, filter, tokenise, shard and pack."""
