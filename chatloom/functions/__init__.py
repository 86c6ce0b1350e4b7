"""Column expressions: text, JSON, numbers and vectors. All stay in the JVM."""
