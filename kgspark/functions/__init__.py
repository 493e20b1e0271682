"""Column functions: identifiers, literals, keys, ranks."""
