"""Column functions: URLs, entities, labels and image hashes."""
