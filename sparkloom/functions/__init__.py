"""Column expressions and small exact services shared by the operators."""
