"""Column expressions shared by every layer; all of them are built-in, code-generated functions."""
