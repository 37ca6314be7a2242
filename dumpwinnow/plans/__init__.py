"""Catalog-specific rules and the resumable build that strings the operators together."""
