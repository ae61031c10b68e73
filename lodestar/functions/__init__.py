"""Column expressions: everything here stays on the JVM side."""
