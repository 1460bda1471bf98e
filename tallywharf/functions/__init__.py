"""Column expressions: every function takes columns and gives a column, all of them JVM-side."""
