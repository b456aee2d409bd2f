"""Column expressions shared by checks and reports."""
