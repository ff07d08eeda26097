"""Column expressions. All of them stay inside generated JVM code."""
