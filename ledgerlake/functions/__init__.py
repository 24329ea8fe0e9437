"""Column-expression and name helpers shared by the operators."""
