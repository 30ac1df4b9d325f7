"""Change streams, incremental state and event tables."""
