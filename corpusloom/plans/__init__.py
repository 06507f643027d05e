"""Plans of queries."""
