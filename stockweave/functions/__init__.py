"""Column expressions and the scale-safe building blocks below the operators."""
