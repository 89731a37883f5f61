"""Column -> Column building blocks. All stay inside the JVM."""
