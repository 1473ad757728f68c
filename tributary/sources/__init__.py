"""Inputs: driver tables, topics (Kafka or directories), derived ledgers."""
