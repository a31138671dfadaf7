"""DataFrame operators: keys, ingest, validation, star building, checks."""
