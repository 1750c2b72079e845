"""lexiflow streaming."""
