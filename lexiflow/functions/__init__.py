"""lexiflow functions."""
