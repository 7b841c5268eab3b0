"""Column functions: keys, dates and fare arithmetic."""
