"""Column -> Column functions. Everything here stays in the JVM."""
