"""Disease-specific data: patterns, word lists, rule tables. The operators know no disease."""
