"""Column-level helpers; everything here returns pyspark Column expressions."""
