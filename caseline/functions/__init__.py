"""Column expressions: text, code and value functions."""
