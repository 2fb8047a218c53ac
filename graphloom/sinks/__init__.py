"""Sinks: the property and edge store, binaries, the run log, and where they are."""
