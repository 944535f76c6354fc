"""Published tables."""
