"""DataFrame operators: landing, drift, dedup, lookups, reshape, quality, publish."""
