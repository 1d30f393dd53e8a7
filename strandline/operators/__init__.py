"""operators of strandline."""
