"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Each source's target (in words) divided by its size is the number of copies
each of its documents should get; the whole part is given to all, the
fractional part is rounded so that the source's words come out right.  Two
documents of a source meet: words move from one's fraction to the other's, at
random but fair in expectation, until one fraction is 0 or 1; that document is
decided, the other carries the rest on.  The sum of words does not change, so
a source ends within one document of its target.

The meetings form a reduction tree: documents are dealt by hash to chunks of
about ``FAN`` of their source, each chunk is folded to decided documents and
one residual, and ``FAN`` residuals at a time form the chunks of the next
level, until one is left per source.  A source that holds a third of all rows
has many chunks, so no task grows with it.  Every level is written to the
shared checkpoint folder.  All random numbers are hashes of the documents, so
reruns agree whatever the partitioning.

Targets: sources in code-point order (null last) weigh ``WEIGHTS``, repeating;
they share ``SHARE`` times all words, and no target exceeds ``MOST`` times its
source's size (the excess is shared by weight among the others).  In closed
form the target is the smaller of that limit and a common level times the
weight; the table of sources (one row each) is the only thing ordered as a whole.

Defined results: a null or empty text has size 0, counts for its source, and
takes 0 words (it is copied as often as its source's whole part); a text of any
length is counted whole; a null source is a source; equal rows (same id, source
and text) are rounded together and get counts that differ by one at most; with
no words at all nothing is taken; an empty table gives an empty table.  Extra
columns stay, whatever their names (``mix``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tributary.llm.common import quoted, write_out
from tributary.llm.rules import words_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
FAN = 64
KEY = ("doc_id", "source", "size", "fp")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size)."""
    place = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS)
    cap = (F.col("source_size") * MOST).cast("double")
    weighed = sizes.select("source", "source_size",
                           F.element_at(F.array(*map(F.lit, WEIGHTS)), (place + 1).cast("int")).alias("weight"))
    # sources by the level at which they reach their limit; those before the first that does not are at it
    by_limit = W.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) * SHARE - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    # the first source below its limit has the common level; counting on past it gives lower values
    open_level = F.when(level * F.col("weight") < cap, level)
    return (weighed.withColumn("level", open_level)
            .select("source", "source_size",
                    F.least(cap, F.coalesce(F.max("level").over(whole) * F.col("weight"), cap)).alias("target")))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def _fold(items: Column) -> Column:
    """One chunk's meetings: struct(r: residual, out: decided documents with their extra copy)."""
    def meet(s: Column, x: Column) -> Column:
        r, out = s["r"], s["out"]
        gain = F.least(r["a"] - r["u"], x["u"])      # words that x can give to r
        loss = F.least(r["u"], x["a"] - x["u"])      # words that r can give to x
        to_r = _uniform(r["h"], x["h"]) * (gain + loss) < loss
        r_done = F.when(to_r, r["a"] - r["u"] <= x["u"]).otherwise(r["u"] <= x["a"] - x["u"])
        extra = F.when(to_r == r_done, F.lit(1)).otherwise(F.lit(0))

        def carried(y: Column, u: Column) -> Column:
            return F.struct(y["h"].alias("h"), y["a"].alias("a"), u.alias("u"), y["d"].alias("d"))

        left_x = F.when(to_r, x["u"] - gain).otherwise(x["u"] + loss)
        left_r = F.when(to_r, r["u"] + gain).otherwise(r["u"] - loss)
        decided = F.struct(F.when(r_done, r["d"]).otherwise(x["d"]).alias("d"), extra.alias("e"))
        return F.struct(F.when(r_done, carried(x, left_x)).otherwise(carried(r, left_r)).alias("r"),
                        F.concat(out, F.array(decided)).alias("out"))

    none = F.transform(F.filter(items, lambda x: F.lit(False)),
                       lambda x: F.struct(x["d"].alias("d"), F.lit(0).alias("e")))
    start = F.struct(F.get(items, F.lit(0)).alias("r"), none.alias("out"))
    return F.aggregate(F.slice(items, 2, F.size(items)), start, meet)


def _levels(open_items: DataFrame) -> DataFrame:
    """Decide every row of (source, chunk, chunks, h, a, u, d): (d, e) with the extra copy e."""
    spark = open_items.sparkSession
    most = open_items.agg(F.max("chunks")).first()[0] or 0
    decided = []
    rows = open_items
    while most:
        item = F.struct("h", "a", "u", "d")
        folded = write_out(spark, (
            rows.groupBy("source", "chunk").agg(F.sort_array(F.collect_list(item)).alias("items"))
            .select("source", "chunk", _fold(F.col("items")).alias("f"))
            .select("source", "chunk", "f.r", "f.out")), "mix-level")
        decided.append(folded.select(F.explode("out").alias("x")).select("x.d", "x.e"))
        rows = folded.select("source", F.floor(F.col("chunk") / FAN).alias("chunk"), "r.h", "r.a", "r.u", "r.d")
        if most == 1:
            # one residual per source: its last fraction of a document falls by chance
            decided.append(rows.select("d", (_uniform(F.col("h")) * F.col("a") < F.col("u")).cast("int").alias("e")))
        most = 0 if most == 1 else -(-most // FAN)
    return reduce(DataFrame.unionAll, decided) if decided else open_items.select("d", F.lit(0).alias("e"))


def decide(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, fp, n_rows, source_size, target, copies) from (doc_id, source, size, fp):
    one row for each group of ``n_rows`` equal rows, with all copies that they get together."""
    spark = docs.sparkSession
    items = write_out(spark, docs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_rows")), "mix-items")
    per_source = items.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n_rows")).cast("long").alias("source_size"),
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / FAN)).cast("long").alias("chunks"))
    planned = targets(per_source.select("source", "source_size"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    table = per_source.join(planned.withColumnRenamed("source", "s").drop("source_size"),
                            F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rated = (items.join(table, same(items, table), "left").drop(table["source"])
             .withColumn("want", F.when(F.col("source_size") > 0, F.col("n_rows") * F.col("target")
                                        / F.col("source_size")).otherwise(F.lit(0.0)))
             .withColumn("given", F.floor("want").cast("long")))
    fixed = (F.col("size") == 0) | (F.col("want") == F.col("given"))
    kept = F.struct(*KEY, "n_rows", "source_size", "target", "given")
    h = F.xxhash64("doc_id", "fp", "size", F.lit(4))
    still_open = rated.where(~fixed).select(
        "source", F.pmod(h, F.col("chunks")).alias("chunk"), "chunks", h.alias("h"),
        F.col("size").cast("double").alias("a"),
        ((F.col("want") - F.col("given")) * F.col("size")).alias("u"), kept.alias("d"))
    done = rated.where(fixed).select(kept.alias("d"), F.lit(0).alias("e")).unionAll(_levels(still_open))
    return done.select(*[f"d.{c}" for c in (*KEY, "n_rows", "source_size", "target")],
                       (F.col("d.given") + F.col("e")).alias("copies"))


def _key_columns(df: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [quoted(id_col).alias("doc_id"), quoted(source_col).alias("source"),
            F.size(words_of(quoted(text_col))).cast("long").alias("size"),
            F.xxhash64(quoted(text_col)).alias("fp")]


def _of_row(place: Column) -> Column:
    """Copies of the row at ``place`` (from 0) among its n_rows equal rows."""
    n = F.col("n_rows")
    return (F.floor(F.col("copies") / n) + (place < F.col("copies") % n).cast("int")).cast("long")


def taken(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, copies) for every row of ``df``."""
    made = decide(df.select(*_key_columns(df, id_col, text_col, source_col)))
    return (made.withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rows") - 1)))
            .select("doc_id", "size", "source_size", "target", _of_row(F.col("place")).alias("copies")))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``df`` as often as it is taken, with its columns unchanged."""
    # inside, input columns go by place: their names may be any
    mine = [f"in{i}" for i in range(len(df.columns))]
    keyed = df.select(*_key_columns(df, id_col, text_col, source_col),
                      *[quoted(c).alias(m) for c, m in zip(df.columns, mine, strict=True)])
    made = decide(keyed.select(*KEY)).where(F.col("copies") > 0)
    made = made.select(*[F.col(c).alias(f"{c}__r") for c in KEY], "n_rows", "copies")
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{c}__r")) for c in KEY])
    joined = keyed.join(made, on)
    equal_rows = W.partitionBy(*KEY).orderBy(KEY[0])
    single = joined.where("n_rows = 1").select(*mine, F.col("copies").cast("int").alias("times"))
    several = joined.where("n_rows > 1").select(
        *mine, _of_row(F.row_number().over(equal_rows) - 1).cast("int").alias("times"))
    both = single.unionAll(several).where("times > 0")
    taken_rows = both.select(*mine, F.explode(F.sequence(F.lit(1), F.col("times"))))
    return taken_rows.select(*mine).toDF(*df.columns)
