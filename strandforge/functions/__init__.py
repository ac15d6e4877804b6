"""Column expressions and the one Arrow UDF."""
