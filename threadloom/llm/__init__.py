"""Training-data operators: sharding, filtering, deduplication, mixing, search, packing."""
