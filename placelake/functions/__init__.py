"""Column-level functions: every one stays inside JVM expressions."""
