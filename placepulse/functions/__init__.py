"""Column functions: text normalization and labels."""
