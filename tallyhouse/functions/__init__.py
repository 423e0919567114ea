"""Column expressions. Everything here is built from Spark's own functions, so it stays in the JVM."""
