"""Column builders: every function takes columns and returns a column, so plans stay in generated code."""
