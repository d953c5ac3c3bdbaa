"""Column-expression helpers (all JVM-side ``pyspark.sql.functions`` compositions)."""
