"""Column expressions. Each takes columns (or names) and returns a column; none needs Python workers."""
