"""Dashboard aggregates computed on report results."""
