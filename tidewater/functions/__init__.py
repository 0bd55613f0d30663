"""Column-expression helpers (all built-in, JVM-side, codegen-friendly)."""
