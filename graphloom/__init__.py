"""Map flat records to an entity graph and keep a versioned property store, on Spark."""
