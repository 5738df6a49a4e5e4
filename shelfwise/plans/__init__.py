"""Jobs and the registry of named queries."""
