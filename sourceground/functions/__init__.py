"""Column functions: markup, text, classification, identifiers."""
