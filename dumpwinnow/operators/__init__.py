"""DataFrame operators: matching, referential subset, integrity checks, lookups."""
