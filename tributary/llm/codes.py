"""Vector code compression: a codebook per part of a vector, fitted by member-resident Lloyd rounds.

Vectors become whole numbers (floor of ``scale`` times a component) and are cut
into ``parts`` equal consecutive parts.  A part position has a codebook of at
most ``entries`` entries that starts as that part of the vectors of smallest
id.  A round assigns every part to its nearest entry, then moves every entry to
the floor of its members' mean.

Members live with their owner.  An owner is a (position, entry, salt); the
members are a table bucketed by those three columns in the shared folder, so
all members of an owner are in one bucket.  A round reads that table in place:

1. owners add up their resident members where they lie; the sums of an entry's
   salts are added and the new codebook, at most parts x entries rows whatever
   the input, goes to the driver and back as a broadcast;
2. owners find the nearest entry for each resident member and write the table
   anew bucket by bucket, without a shuffle: a member that keeps its entry stays
   where it is, one that changes is marked with the entry it goes to;
3. the marked members alone are shuffled to their new owners and appended to
   those owners' buckets.

An entry whose members would be more than ``owner_rows`` is dealt over several
salts, so a hot entry (many equal vectors) is split among owners; the number of
salts of an entry only grows, hence residents never move for it.  The number of
rows of an owner is bounded by about ``owner_rows``, which itself is bounded by
``OWNER_ROWS``.  All tables are in the shared folder: a lost executor costs the
tasks that it was running.

Defined results: rows whose vector is null or holds a null or non-finite
component take no part; a shorter vector counts as padded with zeros, and so
does a length that is no multiple of the parts; scaled components beyond
+-2**25 are cut to that bound.  Equal distances go to the lower entry.  Rows
with equal ids, repeated rows and rows without an id are coded each; for the
first entries null ids come last and equal ids are ordered by vector.  With
fewer rows than entries the codebooks are as long as there are rows; an empty
table gives an empty table.  Equal labels are summed together, nulls too.
Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import quoted, write_out
from tributary.llm.vectors import is_usable, joined, lists, long_sum, matrix, nearest, whole
from tributary.session import scratch_path

OWNER_ROWS = 65_536
BUCKET_ROWS = 16_384
OWNER = ("position", "entry", "salt")
MEMBER = "position int, entry int, salt int, uid long, x array<int>, goes int"


class Members:
    """The bucketed table of all parts, by owner; ``goes`` is the entry a member belongs to after the last round."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.name, self.used = spark, buckets, None, []

    def _write(self, rows: DataFrame, name: str, mode: str, path: str | None = None) -> None:
        out = rows.write.mode(mode).format("parquet").bucketBy(self.buckets, *OWNER)
        (out.option("path", path) if path else out).saveAsTable(name)

    def replace(self, rows: DataFrame) -> None:
        """Write a new table of all members; rows that come from this table's owners stay in their buckets."""
        name = f"members_{uuid.uuid4().hex}"
        self._write(rows, name, "errorifexists", scratch_path(self.spark, "code-members"))
        self.used.append(name)
        self.name = name

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def residents(self) -> DataFrame:
        return self.table().where("goes = entry")

    def migrate(self, salts: np.ndarray) -> None:
        """Send members that change their entry to the buckets of their new owners."""
        movers = self.table().where("goes <> entry")
        self._write(dealt(movers, salts).repartition(self.buckets, *OWNER), self.name, "append")

    def drop(self) -> None:
        """Take the tables out of the catalogue; their files stay in the shared folder."""
        for name in self.used:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def dealt(rows: DataFrame, salts: np.ndarray) -> DataFrame:
    """Rows (position, goes, uid, x) as members of their new owners; salts: by position and entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, goes, uid = (batch.column(i).to_numpy() for i in range(3))
            mixed = (uid.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            salt = (mixed >> np.uint64(33)).astype(np.int64) % salts[position, goes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(salt.astype(np.int32)), batch.column(2), batch.column(3),
                 batch.column(1)], names=["position", "entry", "salt", "uid", "x", "goes"])
    return rows.select("position", "goes", "uid", "x").mapInArrow(run, MEMBER)


def _first_entries(books: list[np.ndarray], width: int):
    """(uid, v) -> (position, goes, uid, x), a row for each part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(1), width * len(books))
            for p, book in enumerate(books):
                x = v[:, p * width:(p + 1) * width]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), p, dtype=np.int32)), pa.array(nearest(x, book)[0].astype(np.int32)),
                     batch.column(0), lists(x)], names=["position", "goes", "uid", "x"])
    return run


def _nearest_parts(batch: pa.RecordBatch, books: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the nearest entry of every member of a batch (position, ..., x last)."""
    position, x = batch.column(0).to_numpy(), matrix(batch.column(batch.num_columns - 1), width)
    at, far = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    for p in np.unique(position).tolist():
        own = position == p
        at[own], far[own] = nearest(x[own], books[p])
    return at, far


def _moved(shared, width: int):
    """(position, entry, salt, uid, x) -> the same with the entry that is nearest now."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            goes = _nearest_parts(batch, shared.value, width)[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(goes.astype(np.int32))],
                                             names=["position", "entry", "salt", "uid", "x", "goes"])
    return run


def _measured(shared, width: int):
    """(position, uid, x) -> (uid, position, code, far): the nearest entry of the last codebook."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, far = _nearest_parts(batch, shared.value, width)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), pa.array(code.astype(np.int32)),
                                              pa.array(far)], names=["uid", "position", "code", "far"])
    return run


def owner_sums(members: DataFrame, width: int) -> DataFrame:
    """(position, entry, salt, n, s0, s1, ...): what each owner's residents add up to; no row moves for it."""
    return members.groupBy(*OWNER).agg(F.count(F.lit(1)).alias("n"),
                                       *[F.sum(F.col("x")[i].cast("long")).alias(f"s{i}") for i in range(width)])


def _updated(books: list[np.ndarray], members: Members, width: int) -> list[np.ndarray]:
    """Every entry that has members at the floor of their mean."""
    sums = (owner_sums(members.residents(), width).groupBy("position", "entry")
            .agg(F.sum("n").alias("n"), *[F.sum(F.col(f"s{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)])
            .collect())
    new = [b.copy() for b in books]
    for r in sums:
        new[r.position][r.entry] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return new


def _salts(counts: list, shape: tuple[int, int], owner_rows: int, before: np.ndarray | None = None) -> np.ndarray:
    """Salts by position and entry, so that none of an entry's owners gets more than about ``owner_rows`` rows."""
    out = np.ones(shape, dtype=np.int64) if before is None else before.copy()
    for r in counts:
        out[r.position, r.goes] = max(out[r.position, r.goes], -(-r["n"] // owner_rows))
    return out


def _counts(rows: DataFrame) -> list:
    """Rows by position and entry: at most parts x entries of them."""
    return rows.groupBy("position", "goes").agg(F.count(F.lit(1)).alias("n")).collect()


@contextmanager
def read_by_bucket(spark: SparkSession):
    """Tasks read whole buckets, also where nothing in the plan asks for it."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fit(rows: DataFrame, parts: int, entries: int, rounds: int, width: int,
        owner_rows: int | None = None) -> tuple[list[np.ndarray], Members]:
    """(codebooks, members) after all rounds; rows: a written table (uid, id, v)."""
    spark = rows.sparkSession
    seeds = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    first = np.array([r.v for r in seeds], dtype=np.int64).reshape(len(seeds), parts * width)
    books = [first[:, p * width:(p + 1) * width].copy() for p in range(parts)]
    total = rows.count() * parts
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = Members(spark, max(1, min(shuffle, -(-total // BUCKET_ROWS))))
    owner_rows = owner_rows or max(64, min(OWNER_ROWS, total // (4 * shuffle)))
    placed = write_out(spark, rows.select("uid", "v").mapInArrow(
        _first_entries(books, width), "position int, goes int, uid long, x array<int>"), "code-parts")
    salts = _salts(_counts(placed), (parts, len(seeds)), owner_rows)
    members.replace(dealt(placed, salts).repartition(members.buckets, *OWNER))
    for k in range(rounds):
        books = _updated(books, members, width)
        if k == rounds - 1:
            break
        shared = spark.sparkContext.broadcast(books)
        members.replace(members.residents().select(*OWNER, "uid", "x").mapInArrow(_moved(shared, width), MEMBER))
        if members.table().where("goes <> entry").isEmpty():
            break           # no part changes its entry: neither will the codebooks
        salts = _salts(_counts(members.table()), salts.shape, owner_rows, salts)
        members.migrate(salts)
    return books, members


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place, in decimal, joined by commas."""
    return hashlib.sha256(joined(n for b in books for n in b.reshape(-1))).hexdigest()


def encode(df: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int = 4, entries: int = 256,
           rounds: int = 4, scale: int = 1024, owner_rows: int | None = None) -> tuple[DataFrame, list[np.ndarray]]:
    """((id, label, code, error, label_error) for every usable row, codebooks)."""
    spark = df.sparkSession
    vector: Column = quoted(vector_col)
    usable = df.where(is_usable(vector)).select(
        quoted(id_col).alias("id"), quoted(label_col).alias("label"), whole(vector, scale).alias("v"))
    longest = usable.agg(F.max(F.size("v")).alias("n")).first().n or 0
    width = max(1, -(-longest // parts))
    zeros = F.array_repeat(F.lit(0), F.lit(width * parts) - F.size("v"))
    rows = write_out(spark, usable.withColumn("v", F.concat("v", zeros))
                     .withColumn("uid", F.monotonically_increasing_id()), "code-rows")
    digits = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("position") == p, F.col("code"))))), 2, "0") for p in range(parts)]
    with read_by_bucket(spark):
        books, members = fit(rows, parts, entries, rounds, width, owner_rows)
        shared = spark.sparkContext.broadcast(books)
        measured = members.residents().select("position", "uid", "x").mapInArrow(
            _measured(shared, width), "uid long, position int, code int, far long")
        coded = measured.groupBy("uid").agg(F.concat(*digits).alias("code"), F.sum("far").alias("error"))
        out = write_out(spark, rows.select("uid", "id", "label").join(coded, "uid").drop("uid"), "codes")
        members.drop()
    per_label = write_out(spark, out.groupBy("label").agg(long_sum(F.col("error")).alias("label_error")), "code-labels")
    per_label = per_label.withColumnRenamed("label", "of")
    result = (out.join(per_label, F.col("label").eqNullSafe(F.col("of")), "left")
              .select("id", "label", "code", "error", "label_error"))
    return result, books
