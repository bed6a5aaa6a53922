"""Training-data operators: dedup, extraction, filtering, mixing and packing."""
