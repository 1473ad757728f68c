"""Exact comparison of many pairs of texts, without sending a text once per pair.

Pairs are dealt to the cells of a grid: by a hash of their first node across, of
their second down.  A text travels once to each cell that has a pair of it, so
in a dense group of n texts it travels about as often as the grid is wide and
not n times.  The grid is as wide as the square root of the work, and a cell that
still has too much of it (a text with very many partners) is cut further, so no
cell gets more than about ``CELL`` units of weight.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = 2_000_000         # words of the pairs of a cell


def matching(pairs: DataFrame, texts: DataFrame, prepare: Callable, match: Callable, cell: int = CELL) -> DataFrame:
    """The (a, b) of ``pairs`` (a, b, weight), a table, for which ``match(prepare(text of a), prepare(text of b))``.

    ``texts``: (node, text), one row for each node of a pair.  ``weight`` is
    about the words of both.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    total = pairs.agg(F.sum("weight").alias("w")).first().w or 0
    width = max(1, int(-(-(total / cell) ** 0.5 // 1)))
    placed = pairs.select("a", "b", "weight", F.pmod(F.xxhash64("a"), F.lit(width)).alias("i"),
                          F.pmod(F.xxhash64("b"), F.lit(width)).alias("j"))
    cuts = placed.groupBy("i", "j").agg(F.ceil(F.sum("weight") / cell).cast("int").alias("cuts"))
    placed = (placed.join(cuts, ["i", "j"])
              .select("i", "j", F.pmod(F.xxhash64("a", "b"), F.greatest("cuts", F.lit(1))).alias("k"), "a", "b"))
    ends = placed.select("i", "j", "k", F.explode(F.array("a", "b")).alias("node")).distinct()
    # other names: both sides of the cogroup come from the same pairs
    sent = ends.join(texts, "node").select(*[F.col(c).alias(f"cell_{c}") for c in "ijk"], "node", "text")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = left.column("a").to_pylist(), left.column("b").to_pylist()
        wanted = set(a) | set(b)
        node, text = right.column("node").to_pylist(), right.column("text")
        ready = {n: prepare(text[i].as_py()) for i, n in enumerate(node) if n in wanted}
        keep = pa.array([match(ready[x], ready[y]) for x, y in zip(a, b, strict=True)], type=pa.bool_())
        return left.select(["a", "b"]).filter(keep)

    return (placed.groupBy("i", "j", "k").cogroup(sent.groupBy("cell_i", "cell_j", "cell_k"))
            .applyInArrow(compare, f"a {kind}, b {kind}"))
