"""Column expressions; every function returns a Column built from JVM-side built-ins."""
