"""Column functions: text, ratings, labels, scores and size parsing."""
