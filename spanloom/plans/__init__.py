"""The registered queries: inputs derived from the given tables, plans, and their oracle SQL."""
