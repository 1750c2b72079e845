"""lexiflow sources."""
