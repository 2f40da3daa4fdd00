"""Column expressions; everything stays inside the JVM."""
