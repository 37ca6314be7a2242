"""The catalog as derived from the star-schema test tables, queries over it, and their SQL."""
