"""Column-to-column helpers; all of them stay in the JVM."""
