"""Column functions: text statistics, lexicons, safety, normalisation, tokens."""
