"""Incremental loading. There is no stream source: a load is one batch past a mark."""
