"""Input tables: schemas, loaders, and the mapping from the generated test data."""
