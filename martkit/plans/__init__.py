"""Query plans: marts and the registry of named queries with their oracle SQL."""
