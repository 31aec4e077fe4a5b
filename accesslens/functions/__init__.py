"""Column -> Column expressions.  Built-ins only, so they stay in codegen."""
