"""Column functions: text cleaners, tokenisers, scalar helpers, fixed lexicons."""
