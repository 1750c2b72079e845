"""lexiflow operators."""
