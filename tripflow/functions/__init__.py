"""Column functions: parsing, trip columns, quality columns."""
