"""Column expressions: Column in, Column out, built-in functions only."""
