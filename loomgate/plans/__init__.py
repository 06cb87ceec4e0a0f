"""Driver-side planning: hierarchy graph, column mapping, execution plans."""
