"""Column expressions and the business values they are built from."""
