"""DataFrame operators: scoring, cleaning, keyed merges, usage and quality queries, monitoring."""
