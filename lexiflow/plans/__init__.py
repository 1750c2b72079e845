"""lexiflow plans."""
