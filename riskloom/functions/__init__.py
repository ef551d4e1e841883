"""Column functions and tail probabilities."""
