"""Column builders; every one stays a built-in JVM expression."""
