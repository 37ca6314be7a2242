"""Native Spark column expressions: name folding, trigrams, dump text and typed values."""
