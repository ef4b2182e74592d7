"""Column expressions shared by the operators and plans."""
