"""Column expressions and declarative feed descriptions."""
