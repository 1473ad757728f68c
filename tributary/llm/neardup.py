"""Near-duplicate classes by DartMinHash signatures and banded joining.

A document's node is the MD5 of its text, so exact copies are one row from the
first aggregation on (partial sums before the shuffle, however many copies).
Each node gets ``BANDS`` band numbers.  Nodes that share one are candidates;
their exact weighted Jaccard similarity on five-word shingles decides, and
classes are the connected components of links of at least ``threshold``.

No bucket is expanded into pairs or collected:

1. every node meets the least node of each of its buckets (a star), the pair
   with most bands in common first; nodes linked so form trees;
2. the other star pairs are compared only between different trees;
3. buckets whose nodes still lie in different classes are settled in blocks of
   about ``BLOCK`` nodes: a group holds two blocks, compares the signatures of
   nodes of different classes by array arithmetic, and gives out only pairs
   whose estimate is above the threshold less ``SIGMAS`` standard deviations and
   whose units, counted by 256 ranges of their hash, differ by no more than a
   link allows (a bound that no link fails), each in the first bucket that its
   nodes share (told by the bucket numbers themselves).  Those are compared
   exactly, too.  A first turn gives out the best pair of every two classes, a
   second all pairs that are still between classes.

So two linked nodes that share a bucket end in one class: the estimate of a link
lies below six standard deviations with a probability of 1e-9.  Two nodes of a
similarity of exactly 0.8 share no bucket with a probability of 0.003, of 0.85
with 0.00004.

A different text also has a number, given as the nodes are written, by which
buckets, pairs and classes name it: half as long as the MD5, and minima of
numbers are found by hashing where those of bytes need a sort.  Buckets are dealt
out once, for their least node and for meeting it.

Texts and signatures are fetched only for the nodes concerned: a bitmap
of ``MARKS`` bits (a fixed size) is broadcast to drop most other rows where
they are read, an exact join follows.  ``keep_one`` uses it, too: rows that the
bitmap of the nodes that lose rows lacks stay where they are read, and only the
texts that have copies (and those that share a bit by chance) are shuffled.  A text travels once per cell of a grid of
pairs (``pairs``), not once per pair.

Classes are found by alternating large-star and small-star steps, every pair
of them written to the shared checkpoint folder.

Defined results: null and blank texts are alone in their class; a text of
fewer than five words is one shingle, one of any length is read whole; repeated
rows and repeated or null ids are rows like others (the class id is the least id
of the class's rows, null only if all are null); of several rows of the least id
``keep_one`` keeps one; an empty table gives an empty table; extra columns stay,
whatever their names (``keep_one``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm import dart
from tributary.llm.common import SPACES, fresh, quoted, write_out
from tributary.llm.pairs import matching

THRESHOLD = 0.8
BLOCK = 512
SIGMAS = 6
MARKS = 1 << 26


def node_of(text: Column) -> Column:
    """The node of a text; null for a text without words."""
    return F.when(F.btrim(text, F.lit(SPACES)) != "", F.unhex(F.md5(text.cast("binary"))))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            size, bands, lanes, counts = [], [], [], []
            for text in part.column(1).to_pylist():
                found = dart.shingles(text)
                darts = dart.signature(found)
                size.append(len(found))
                count = np.bincount((dart.regions(found) >> np.uint64(56)).astype(np.int64), minlength=256)
                counts.append(np.minimum(count, 255).astype(np.uint8).tobytes())
                bands.append(dart.bands(darts))
                lanes.append((darts >> np.uint64(40)).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(size, type=pa.int64()), pa.array(bands, type=pa.list_(pa.int64())),
                 pa.array(lanes, type=pa.binary()), pa.array(counts, type=pa.binary())],
                names=["key", "size", "bands", "lanes", "counts"])


def sketch(docs: DataFrame) -> DataFrame:
    """(key, node, size, bands, lanes, counts), one row per different text of (key, text); node: its number, lanes: two
    bytes of each dart, counts: units by range of their hash, 255 at most.  To be written before it is read twice."""
    made = docs.where(F.col("key").isNotNull()).mapInArrow(
        _sketch, "key binary, size long, bands array<long>, lanes binary, counts binary")
    found = made.groupBy("key").agg(*[F.first(c).alias(c) for c in ("size", "bands", "lanes", "counts")])
    return found.withColumn("node", F.monotonically_increasing_id())


def _bit(node: Column) -> Column:
    return F.when(node.isNotNull(), F.pmod(F.xxhash64(node), F.lit(MARKS)) + 1)


def _marks(nodes: DataFrame) -> DataFrame:
    """The bitmap of ``MARKS`` bits with one set for each node, in pieces (__k, __m), written."""
    bit = nodes.select(_bit(F.col("node")).alias("bit"))
    return write_out(nodes.sparkSession, bit.groupBy(F.bitmap_bucket_number("bit").alias("__k"))
                     .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("__m")), "near-marks")


def _marked(rows: DataFrame, node: str, marks: DataFrame, negate: bool = False) -> DataFrame:
    """The rows whose node may be one of those that ``marks`` was made of; ``negate``: the others, with null nodes.

    The pieces of the bitmap go to every task, so no row moves.
    """
    k, m = (fresh(rows.columns, c) for c in ("__k", "__m"))
    pieces = F.broadcast(marks.select(F.col("__k").alias(k), F.col("__m").alias(m)))
    bit = _bit(quoted(node))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(quoted(m), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    found = rows.join(pieces, F.bitmap_bucket_number(bit) == quoted(k), "left" if negate else "inner")
    return found.where(~hit if negate else hit).select(*[quoted(c) for c in rows.columns])


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The written (a, b) of ``pairs`` whose texts are similar enough, by exact comparison of their shingles."""
    spark = docs.sparkSession
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    keys = write_out(spark, nodes.select("node", "key").join(ends, "node"), "near-keys")
    some = _marked(docs.where(F.col("key").isNotNull()), "key", _marks(keys.select(F.col("key").alias("node"))))
    texts = some.join(keys, "key").groupBy("node").agg(F.first("text").alias("text"))
    size = lambda c: nodes.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"))
    weighed = write_out(spark, pairs.join(size("a"), "a").join(size("b"), "b").select(
        "a", "b", (F.col("size_a") + F.col("size_b")).alias("weight")), "near-weighed")
    return matching(weighed, texts, dart.units, lambda x, y: dart.similarity(x, y) >= threshold)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node of its component."""
    spark = edges.sparkSession
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        # large star: a node's larger neighbours join its least neighbour
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours join the least of them
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        current = write_out(spark, small, "near-stars")
        # done when every node points to one other, which points to none
        sides = (current.select(F.col("a").alias("node"), F.lit(1).alias("side"))
                 .unionAll(current.select(F.col("b").alias("node"), F.lit(1000).alias("side")).distinct()))
        if sides.groupBy("node").agg(F.sum("side").alias("s")).where("s NOT IN (1, 1000)").isEmpty():
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _rooted(nodes: DataFrame, column: str, roots: DataFrame, out: str) -> DataFrame:
    """``nodes`` with the root of ``column`` (itself where it has none) added as ``out``."""
    found = roots.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    return (nodes.join(found, F.col(column) == F.col("__n"), "left")
            .withColumn(out, F.coalesce("__r", column)).drop("__n", "__r"))


def _block_pairs(threshold: float, best_only: bool):
    """Two blocks of a bucket -> pairs of different classes that may be similar enough, by their signatures."""
    cut = threshold - SIGMAS * (threshold * (1 - threshold) / (dart.ROWS * dart.BANDS)) ** 0.5

    def run(table: pa.Table) -> pa.Table:
        block, low, high = (table.column(c).to_numpy() for c in ("block", "low", "high"))
        node, root = (table.column(c).to_pylist() for c in ("node", "root"))
        size, band = table.column("size").to_numpy(), table.column("band")[0].as_py()
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype=np.uint8).reshape(len(node), -1)
        counts = counts.astype(np.int16)
        lanes = np.frombuffer(b"".join(table.column("lanes").to_pylist()), dtype="<u2").reshape(len(node), -1)
        number = {r: i for i, r in enumerate(sorted(set(root)))}
        tree = np.array([number[r] for r in root])
        found: dict[tuple[int, int], tuple[float, int, int]] = {}
        for i in np.flatnonzero(block == low).tolist():
            others = np.flatnonzero((block == high) & (tree != tree[i])
                                    & (np.minimum(size, size[i]) >= threshold * np.maximum(size, size[i])))
            others = others[others > i] if low[0] == high[0] else others
            # a pair counts in the first of its common buckets only
            others = others[(bands[others] == bands[i]).argmax(axis=1) == band]
            both = size[others] + size[i]
            apart = np.abs(counts[others] - counts[i]).sum(axis=1)
            others = others[apart <= both * (1 - threshold) / (1 + threshold) + 1e-6]
            estimate = (lanes[others] == lanes[i]).mean(axis=1)
            for j, e in zip(others[estimate >= cut].tolist(), estimate[estimate >= cut].tolist(), strict=True):
                x, y = (i, j) if node[i] > node[j] else (j, i)
                key = (min(tree[i], tree[j]), max(tree[i], tree[j])) if best_only else (x, y)
                if key not in found or e > found[key][0]:
                    found[key] = e, x, y
        out = {"a": [node[x] for _, x, _ in found.values()], "b": [node[y] for _, _, y in found.values()],
               "ra": [root[x] for _, x, _ in found.values()], "rb": [root[y] for _, _, y in found.values()]}
        return pa.table({**{c: pa.array(v, type=pa.int64()) for c, v in out.items()},
                         "estimate": pa.array([e for e, _, _ in found.values()], type=pa.float64())})
    return run


def _settle(members: DataFrame, nodes: DataFrame, roots: DataFrame, threshold: float, best_only: bool) -> DataFrame:
    """Candidate pairs (a, b) of different classes in the buckets whose nodes lie in several classes."""
    now = _rooted(members, "node", roots, "root")
    open_buckets = (now.groupBy("bucket").agg(F.min("root").alias("r1"), F.max("root").alias("r2"),
                                              F.count(F.lit(1)).alias("n"))
                    .where("r1 <> r2").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    spark = nodes.sparkSession
    now = write_out(spark, now.join(open_buckets, "bucket"), "near-open")
    # the signatures of other nodes stay where they are read
    signed = _marked(nodes.select("node", "lanes", "bands", "counts"), "node", _marks(now.select("node")))
    left = (now.join(signed, "node")
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    paired = left.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                         "block", "band", "node", "root", "size", "lanes", "bands", "counts")
    pairs = (paired.groupBy("bucket", "low", "high")
             .applyInArrow(_block_pairs(threshold, best_only),
                           "a long, b long, ra long, rb long, estimate double"))
    if not best_only:
        return pairs.select("a", "b").distinct()
    return (pairs.groupBy(F.least("ra", "rb").alias("r1"), F.greatest("ra", "rb").alias("r2"))
            .agg(F.max(F.struct("estimate", "a", "b")).alias("x")).select("x.a", "x.b"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, root) for the keys of (key, text) that have a near duplicate of a different text; root: a key, too."""
    spark = docs.sparkSession
    nodes = write_out(spark, sketch(docs), "near-nodes")
    # dealt by bucket once: both sides below read this exchange, so they need the same columns of it
    members = nodes.select("node", "size", F.posexplode("bands").alias("band", "bucket")).repartition("bucket")
    # each bucket's least node is met by the others
    centre = (members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                            F.min(F.struct("node", "size", "band")).alias("c"))
              .where("n > 1").select("bucket", "c"))
    members = write_out(spark, members.join(centre, "bucket"), "near-members")
    star = write_out(spark, (
        members.where("node <> c.node")
        .select(F.col("node").alias("a"), F.col("c.node").alias("b"), F.col("size").alias("size_a"),
                F.col("c.size").alias("size_b"))
        .where(F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * threshold)
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("bands"))), "near-star")
    best = star.groupBy("a").agg(F.max(F.struct("bands", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    first = write_out(spark, best, "near-first")
    links = write_out(spark, verified(first, docs, nodes, threshold), "near-links")
    roots = components(links)

    def between(pairs: DataFrame) -> DataFrame:
        return (_rooted(_rooted(pairs, "a", roots, "ra"), "b", roots, "rb").where("ra <> rb").select("a", "b"))

    def compare(pairs: DataFrame) -> None:
        nonlocal links, roots
        found = write_out(spark, verified(pairs, docs, nodes, threshold), "near-links")
        if not found.isEmpty():
            links = links.unionAll(found)
            roots = components(links)

    compare(write_out(spark, between(star.join(first, ["a", "b"], "left_anti")), "near-rest"))
    members = members.select("bucket", "band", "node", "size")
    compared = star.select("a", "b")
    for best_only in (True, False):
        pairs = write_out(spark, _settle(members, nodes, roots, threshold, best_only)
                          .join(compared, ["a", "b"], "left_anti"), "near-pairs")
        compare(pairs)
        compared = compared.unionAll(pairs)
    names = nodes.select("node", "key")
    return (roots.join(names, "node").select("key", F.col("root").alias("node"))
            .join(names.withColumnRenamed("key", "root"), "node").select("key", "root"))


def assign(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, class_rows) for every row of ``df``."""
    rows, groups = _grouped(df, id_col, text_col, threshold)
    held = groups.select(F.col("node").alias("__n"), "class_id", "class_rows")
    return (rows.join(held, F.col("node") == F.col("__n"), "left")
            .select("doc_id", F.when(F.col("__n").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
                    .alias("class_id"), F.coalesce("class_rows", F.lit(1).cast("long")).alias("class_rows")))


def _grouped(df: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """All rows as (doc_id, node), and the nodes in classes of several rows with their class."""
    text = quoted(text_col).cast("string")
    docs = df.select(node_of(text).alias("key"), text.alias("text"))
    rows = df.select(quoted(id_col).alias("doc_id"), node_of(text).alias("node"))
    copies = rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    roots = classes(docs, threshold).withColumnRenamed("key", "node")
    rooted = write_out(df.sparkSession, _rooted(copies, "node", roots, "root"), "near-rooted")
    first = F.min(F.struct(F.col("least").isNull(), "least", "node"))
    per_class = (rooted.groupBy("root").agg(first.alias("f"), F.sum("n").alias("class_rows"))
                 .where("class_rows > 1"))
    groups = rooted.join(per_class, "root").select(
        "node", F.col("f.least").alias("class_id"), "class_rows", F.col("f.node").alias("first_node"), "n", "least")
    return rows, groups


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with one row of each class: the least id's (one of them if the row repeats)."""
    spark = df.sparkSession
    _, groups = _grouped(df, id_col, text_col, threshold)
    # what may lose rows: the nodes of a class but its first, and the first if its text has copies
    loses = groups.where("node <> first_node OR n > 1").select(
        "node", (F.col("node") == F.col("first_node")).alias("first"), "least")
    taken = list(df.columns)
    node, key, least = (fresh(taken, c) for c in ("__node", "__key", "__least"))
    mine = [quoted(c) for c in df.columns]
    only = df.select(node_of(quoted(text_col).cast("string")).alias("node"))
    rows = df.withColumn(node, node_of(quoted(text_col).cast("string")))
    loses = write_out(spark, loses, "near-loses")
    marks = _marks(loses)
    sure = _marked(rows, node, marks, negate=True)
    # marked, but not among them: the nodes are found first, so that only their texts move
    extra = write_out(spark, _marked(only, "node", marks).distinct().join(loses, "node", "left_anti"), "near-extra")
    extra_rows = (_marked(rows, node, _marks(extra))
                  .join(extra.select(F.col("node").alias(key)), quoted(node) == quoted(key), "left_semi"))
    # of a text's copies those with the least id: more than one row only if rows repeat
    copies = loses.where("first").select(F.col("node").alias(key), F.col("least").alias(least))
    repeated = (_marked(rows, node, _marks(copies.select(quoted(key).alias("node"))))
                .join(copies, (quoted(node) == quoted(key)) & quoted(id_col).eqNullSafe(quoted(least))))
    return (sure.select(*mine).unionAll(extra_rows.select(*mine))
            .unionAll(repeated.dropDuplicates([node]).select(*mine)))
