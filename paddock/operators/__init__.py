"""Column-parameterised DataFrame operators."""
