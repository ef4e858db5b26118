"""Training-data operators: personal data, sharding, mixing, token files, near-duplicates, archives."""
