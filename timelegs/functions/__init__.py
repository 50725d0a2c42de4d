"""Column expressions. All are built from native functions, so they stay in codegen."""
