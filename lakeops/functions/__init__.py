"""Column expressions. No Python UDFs: everything stays inside generated code."""
