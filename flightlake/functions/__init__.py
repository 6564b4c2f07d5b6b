"""Column helpers: each returns a Column built from JVM-side functions."""
