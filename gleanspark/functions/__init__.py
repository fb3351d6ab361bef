"""Column expressions and Arrow passes over urls, keywords, markup and texts."""
