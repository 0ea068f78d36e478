"""Column-expression helpers; everything compiles to built-in Spark expressions."""
