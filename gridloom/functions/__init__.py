"""Column expressions for cell text and numbers."""
