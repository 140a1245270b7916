"""Column expressions. Every function here returns a built-in JVM expression."""
