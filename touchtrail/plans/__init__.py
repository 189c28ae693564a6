"""Model graph, pipeline, and the registered queries with their SQL oracles."""
