"""Column functions: rounding rules, names, text, vectors, boxes."""
