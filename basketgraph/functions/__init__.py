"""Column-expression helpers built on pyspark.sql.functions (no Python UDFs)."""
