"""Training-data operators: tokenising, deduplication, mixing, scoring, filtering and extraction."""
