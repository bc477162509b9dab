"""Column builders: cleaning, point rules, scores."""
