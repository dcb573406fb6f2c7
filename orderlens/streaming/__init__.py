"""Incremental loading: increment filter, high-water mark, file-driven stream."""
