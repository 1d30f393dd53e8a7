"""plans of strandline."""
