"""Part of the beadloom engine."""
