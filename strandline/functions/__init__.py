"""functions of strandline."""
