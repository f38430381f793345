"""Training-data operators: cleaning, classification, deduplication, mixing, output."""
