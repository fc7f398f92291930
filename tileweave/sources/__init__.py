"""Sources, sinks and derived tables."""
