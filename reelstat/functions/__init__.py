"""Column expressions shared by the operators (all built-in, JVM-side)."""
