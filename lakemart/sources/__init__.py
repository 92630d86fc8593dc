"""Sources, sinks and catalog operations."""
