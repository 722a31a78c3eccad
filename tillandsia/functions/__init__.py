"""Spark SQL expression helpers (built-in functions only: JVM-side, codegen'd)."""
