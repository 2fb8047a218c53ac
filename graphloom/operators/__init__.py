"""DataFrame operators: fan-out, ids, lookups, counts and versioned updates."""
