"""Column builders: text, dates, numbers, geometry, JSON and hashes; and vectorised fuzzy scorers."""
