"""Column expressions and DataFrame helpers shared by the operators."""
