"""Document-retrieval analytics on Spark: pages -> elements -> vectors -> ranked context."""
