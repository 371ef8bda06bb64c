"""Column functions: text, time, vectors and variants."""
