"""Column functions: text, metrics and scores."""
