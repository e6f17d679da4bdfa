"""Training-data operators: extraction, privacy, de-duplication, filtering, mixing, scoring, sharding."""
