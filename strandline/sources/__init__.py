"""sources of strandline."""
