"""Plain SQL counterparts of the queries, for checking results."""
