"""Column functions: text, dates, bins and tail probabilities."""
