"""Column functions: text, arrays and data types."""
