"""Column functions: text, numbers, times, hashes, conditions, branches and steps."""
