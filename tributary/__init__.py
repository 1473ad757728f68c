"""tributary: event-stream analytics and transfer ledgers on Spark DataFrames.

Subpackages:
  sources    table, topic and generated inputs
  sinks      topic / directory writers
  functions  column-level helpers (text, JSON codec, ledger rules)
  operators  DataFrame -> DataFrame operators (aggregates, folds, joins, windows)
  streaming  Structured Streaming jobs and stateful processors
  plans      the registered query catalog and its SQL oracles
"""

from tributary.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
