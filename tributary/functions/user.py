"""Users' own functions over streams and tables: flat maps and keyed process functions.

``flat_map`` takes a function from one Arrow batch to Arrow tables of any number
of rows, as a table function; no batch holds more than about ``PART_BYTES``
(longer rows come alone), so a task's memory doesn't grow with its rows.  ``keyed_process`` takes a function that sees the
rows of a key, may keep a value per key between micro-batches, and gives rows to
named outputs; ``output`` picks one of them.  It runs on a stream or on a table.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

# the driver-side worker of a stateful query does not see files added with addPyFile
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = "output"
PART_BYTES = 1 << 20


def parts(batch: pa.RecordBatch, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about ``size`` bytes; a longer row comes alone."""
    bytes_to = [0] * (batch.num_rows + 1)
    if batch.nbytes > size:
        lengths = np.zeros(batch.num_rows, dtype=np.int64)
        for column in batch.columns:
            wide = pa.types.is_string(column.type) or pa.types.is_binary(column.type) \
                or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
            lengths += pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False) if wide \
                else -(-column.nbytes // max(1, batch.num_rows))
        bytes_to = [0, *np.cumsum(lengths).tolist()]
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, bisect_right(bytes_to, bytes_to[at] + size) - 1)
        yield batch.slice(at, end - at)
        at = end


def flat_map(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.Table]], schema: str) -> DataFrame:
    """All tables that ``function`` makes of the batches of ``df``."""
    class FlatMap:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            for part in parts(batch):
                yield from function(part)

    return F.arrow_udtf(FlatMap, returnType=schema)(df.asTable())


class KeyState:
    """The value that a process function keeps for the key at hand."""

    def __init__(self, state):
        self._state = state

    def get(self):
        found = self._state.get()
        return found[0] if found else None

    def put(self, value) -> None:
        self._state.update((value,))

    def clear(self) -> None:
        self._state.clear()


class _Process(StatefulProcessor):
    def __init__(self, function, state: str, columns: list[str]):
        self.function, self.state, self.columns = function, state, columns

    def init(self, handle) -> None:
        self.value = handle.getValueState("value", f"value {self.state}")

    def handleInputRows(self, key, rows, timerValues):
        state = KeyState(self.value)
        for frame in rows:
            if len(frame):
                for name, out in self.function(key, frame, state):
                    if len(out):
                        yield out.assign(**{OUTPUT: name})[self.columns]

    def close(self) -> None:
        pass


def keyed_process(df: DataFrame, key: list[str],
                  function: Callable[[tuple, pd.DataFrame, KeyState], Iterator[tuple[str, pd.DataFrame]]],
                  schema: T.StructType, state: str = "string") -> DataFrame:
    """Rows of all outputs, with the output's name in ``output``.

    ``function(key, rows, state)`` gives (output name, rows); ``state`` is the
    type of the value it may keep for a key.  A key's rows may come in several
    calls.
    """
    from tributary.streaming.jobs import use_rocksdb
    use_rocksdb(df.sparkSession)
    # tasks report their state stores to the coordinator, which begins with the
    # session's stream manager; a table alone would not begin it
    _ = df.sparkSession.streams
    home = sys.modules.get(function.__module__)
    if home is not None and function.__module__ != "__main__":
        cloudpickle.register_pickle_by_value(home)
    full = T.StructType([*schema.fields, T.StructField(OUTPUT, T.StringType())])
    return df.groupBy(*key).transformWithStateInPandas(_Process(function, state, full.fieldNames()), full, "append", "None")


def output(processed: DataFrame, name: str) -> DataFrame:
    """One named output of a keyed process function."""
    return processed.where(F.col(OUTPUT) == name).drop(OUTPUT)
