"""Column-expression helpers (dates, rounding, text); all JVM-side."""
