"""Column expressions shared by the slice jobs (all JVM-side, no Python UDFs)."""
