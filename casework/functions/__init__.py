"""Column functions and small DataFrame recipes used by the operators."""
