"""Column functions: text and keys, time, VARIANT access."""
