"""Column expressions: calendar arithmetic, price arithmetic, isolation depth."""
