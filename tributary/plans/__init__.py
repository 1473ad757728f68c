"""Registered queries (name -> callable(spark, sf_dir)) and SQL oracles."""
