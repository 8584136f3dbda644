"""Column functions: pure expressions over columns, no actions."""
