"""Column functions: text, keys, dates, YAML scalars, hashes."""
