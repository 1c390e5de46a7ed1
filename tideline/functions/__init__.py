"""Column functions: lenient parsing, dates and fiscal periods, masking."""
