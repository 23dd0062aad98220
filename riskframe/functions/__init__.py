"""Column expressions: scalar functions without Python UDFs."""
