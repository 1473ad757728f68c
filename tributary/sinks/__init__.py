"""Outputs: topics (Kafka or directories) and routed writes."""
