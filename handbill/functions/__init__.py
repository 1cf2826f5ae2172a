"""Column functions: text folding, dates, prices, keys, keyword matching."""
