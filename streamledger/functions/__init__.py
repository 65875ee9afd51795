"""Column expressions: Java-compatible split, tokenisers, parsers."""
