"""strandline: text-corpus resolution, graph and data-quality operators as Spark plans."""
