"""Analytics for curating time-based, hierarchical evidence data, as Spark plans."""
