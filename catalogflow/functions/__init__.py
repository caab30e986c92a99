"""Column functions: text, prices, URLs, packed records and numbering."""
