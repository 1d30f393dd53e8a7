"""streaming of strandline."""
