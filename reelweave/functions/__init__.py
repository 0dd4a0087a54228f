"""Column functions: text parsing, value normalisation and measures."""
