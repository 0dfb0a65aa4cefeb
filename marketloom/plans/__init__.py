"""Named queries and their SQL equivalents, grouped by family."""
