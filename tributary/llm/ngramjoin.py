"""N-gram Jaccard self-join by rare-first prefix filtering, and its connected documents.

A text's set holds its distinct three-word shingles (words in lower case for
A-Z), as 64-bit hashes.  Two texts link when ``100 * common >= percent * union``.

All sets are ordered by one global order: first the shingles whose hash is a
multiple of ``RANKED`` by how many texts hold them (rare first, ties by hash),
then the others by hash.  Any fixed order is right for prefix filtering; ranking
one shingle in ``RANKED`` by frequency is enough, since a prefix is about a
tenth of a set, and leaves only that share to count and shuffle.  Frequencies are
counted over all texts.  Shingles that one text alone holds come first in its
order and can link nothing: a text whose prefix has only such ones is out before
any join.

Texts that link share a shingle within their prefixes of
``n - ceil(percent * n / 100) + 1`` shingles.  Candidates share one and pass

* the length filter: the smaller set is large enough for the larger;
* the positional filter: what stands behind a common shingle in both orders is
  enough for the overlap that a link needs.  It holds for a pair's first common
  shingle, so a pair that links passes it at least there;
* the suffix filter: sets are split by hash into 256 ranges; the differences of
  their counts, up to 255 each, bound the symmetric difference from below.

Pairs that remain are compared once, on the whole sets made from the texts.

A shingle that n texts have in their prefixes isn't expanded into n * n pairs:

1. in every list of texts by (prefix shingle, class of sizes) all meet the least
   text of the list, the partner with most prefix shingles in common first;
2. lists whose texts still lie in different components are compared in groups
   of many short lists, or of two blocks of ``BLOCK`` texts of a long one (blocks
   are by size class, and only blocks of equal or neighbouring classes meet).
   Such a group gives out only pairs of different components that pass all
   filters.  In a first turn, of short lists and of each block with itself, and in
   a second, of a block with others, it gives out a least spanning forest of its
   components by distance, fewer pairs than rows; in a third all pairs that are
   left.  No pair that could link two components is left out.

Exact copies of a text are one node from the start.  Texts travel only for nodes
of lists of two or more, and once per cell of a grid of pairs (``pairs``), not
once per pair.

Two different shingles with one 64-bit hash count as one; for two texts of
20,000 words the odds of that are below 1e-10.

Defined results: null texts and texts without words have an empty set and are
alone; a text of one or two words is one shingle; texts of any length are read
whole, in pieces of bounded size; repeated rows and rows of equal ids are rows
like others; rows without an id are linked, too (a component's id is its least
id, null only if it has none).  An empty table gives an empty table.  Extra
columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tributary.llm.common import SPACES, quoted, write_out
from tributary.llm.dart import mix
from tributary.llm.neardup import components
from tributary.llm.pairs import matching

WORDS = 3
PERCENT = 90
RANKED = 4               # one shingle in so many is ranked by frequency
RANGES = 256             # of the suffix filter
BLOCK = 256
GROUP_ROWS = 20_000      # rows of short lists that are compared together
MARKS = 1 << 26
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_MUL = (np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _hashes(raw: bytes) -> np.ndarray:
    words = raw.lower().split()          # bytes: A-Z only, and the six ASCII white space characters
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def word_hashes(raw: bytes) -> np.ndarray:
    """Hashes of all words; a long text is read in pieces that end at white space."""
    if len(raw) <= PIECE:
        return _hashes(raw)
    out, at = [], 0
    while at < len(raw):
        found = _SPACE.search(raw, at + PIECE)
        end = found.start() if found else len(raw)
        out.append(_hashes(raw[at:end]))
        at = end
    return np.concatenate(out)


def shingle_set(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted; fewer than three words make one shingle, none makes none."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if len(words) < WORDS:
        return mix(np.array([np.sum(words * _MUL[:len(words)]) + np.uint64(len(words))], dtype=np.uint64)) \
            if len(words) else words
    n = len(words) - WORDS + 1
    total = words[:n] * _MUL[0]
    for j in range(1, WORDS):
        total = total + words[j:n + j] * _MUL[j]
    return np.unique(mix(total))


def prefix_length(n, percent: int):
    """Shingles of a set of ``n`` that a partner must share one of."""
    return n + (-percent * n) // 100 + 1


def needed(a, b, percent: int):
    """Least overlap of linked sets of these sizes."""
    return -((-percent * (a + b)) // (100 + percent))


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    if not len(a) or not len(b):
        return False
    both = np.sort(np.concatenate((a, b)))
    return int((both[1:] == both[:-1]).sum()) >= needed(len(a), len(b), percent)


def node_key(text: Column) -> Column:
    """The key of a text; null for a text without words."""
    return F.when(F.btrim(text, F.lit(SPACES)) != "", F.unhex(F.md5(text.cast("binary"))))


def _long_lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int64)
    flat = np.concatenate([np.zeros(0, dtype=np.uint64), *parts]).view(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat)).cast(pa.list_(pa.int64()))


def _sketched(percent: int):
    """(key, text) -> (key, size, ranked, more, counts); more: the prefix's shingles behind the ranked ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                size, ranked, more, counts = [], [], [], []
                for text in part.column(1).to_pylist():
                    s = shingle_set(text)
                    first = s % np.uint64(RANKED) == 0
                    size.append(len(s))
                    ranked.append(s[first])
                    more.append(s[~first][:max(0, prefix_length(len(s), percent) - len(ranked[-1]))])
                    count = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=RANGES)
                    counts.append(np.minimum(count, 255).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, type=pa.int32()), _long_lists(ranked), _long_lists(more),
                     pa.array(counts, type=pa.binary())], names=["key", "size", "ranked", "more", "counts"])
    return run


def _marks(values: DataFrame) -> bytes:
    """A bitmap of ``MARKS`` bits, a fixed size, with one set for each number of the only column."""
    v = quoted(values.columns[0])
    bit = (F.shiftrightunsigned(v, 8).bitwiseAND(F.lit(MARKS - 1)) + 1).alias("bit")
    found = (values.select(bit).groupBy(F.bitmap_bucket_number("bit").alias("k"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("m")).collect())
    width, out = 4096, bytearray(MARKS // 8)       # bytes of one of Spark's bitmaps, which are numbered from 1
    for k, m in found:
        out[(k - 1) * width:k * width] = m
    return bytes(out)


def _hit(marks: np.ndarray, values: np.ndarray) -> np.ndarray:
    bit = ((values.view(np.uint64) >> np.uint64(8)) & np.uint64(MARKS - 1)).astype(np.int64)
    return (marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _shared_postings(shared):
    """(node, size, ranked) -> (token, node, size, n_ranked) for tokens that may occur in several texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            node, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(2)
            n = lists.value_lengths().to_numpy()
            token = lists.flatten().to_numpy()
            of = np.repeat(np.arange(len(n)), n)
            hit = _hit(marks, token)
            of = of[hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[hit]), pa.array(node[of]), pa.array(size[of]), pa.array(n[of].astype(np.int32))],
                names=["token", "node", "size", "n_ranked"])
    return run


def prefixes(nodes: DataFrame, percent: int) -> DataFrame:
    """(token, node, size, pos): the prefix shingles that several texts hold, with their place in the text's order."""
    spark = nodes.sparkSession
    frequent = write_out(spark, nodes.select(F.explode("ranked").alias("token")).groupBy("token")
                         .agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "join-tokens")
    shared = spark.sparkContext.broadcast(_marks(frequent.select("token")))
    postings = nodes.select("node", "size", "ranked").mapInArrow(
        _shared_postings(shared), "token long, node long, size int, n_ranked int").join(frequent, "token")
    own = W.partitionBy("node")
    placed = postings.select(
        "token", "node", "size", "n_ranked", F.count(F.lit(1)).over(own).alias("n_shared"),
        F.row_number().over(own.orderBy("df", "token")).alias("rank"))
    place = F.col("n_ranked") - F.col("n_shared") + F.col("rank") - 1
    length = F.expr(f"size - (size * {percent} + 99) div 100 + 1")
    first = placed.select("token", "node", "size", place.cast("int").alias("pos")).where(F.col("pos") < length)
    behind = nodes.select("node", "size", F.size("ranked").alias("n"), F.posexplode("more").alias("k", "token")).select(
        "token", "node", "size", (F.col("n") + F.col("k")).alias("pos"))
    return first.unionAll(behind)


def _size_class(size: Column, percent: int) -> Column:
    """Linked sets lie in one class or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit((100 + 1e-6) / percent))).cast("int")


def _possible(a: Column, b: Column, i: Column, j: Column, percent: int) -> Column:
    """Length and positional filter of two sets of sizes a, b with a common shingle at places i, j."""
    least = F.ceil((a + b) * percent / F.lit(100 + percent) - 1e-9)
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & (F.least(a - i, b - j) >= least)


def _suffix_kept(percent: int):
    """(a, b, size_a, size_b, counts_a, counts_b) -> (a, b, weight) that pass the suffix filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
                x, y = (_counts(batch.column(i).to_pylist()) for i in (4, 5))
                keep = np.abs(x - y).sum(axis=1) <= a + b - 2 * needed(a, b, percent)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(a + b)],
                                                 names=["a", "b", "weight"]).filter(pa.array(keep))
    return run


def _counts(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(len(rows), RANGES).astype(np.int16)


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The written (a, b) of ``pairs`` that pass the suffix filter and link, each compared once."""
    spark = pairs.sparkSession
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"),
                                  F.col("counts").alias(f"counts_{c}"))
    left = write_out(spark, pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", "size_a", "size_b", "counts_a", "counts_b").mapInArrow(_suffix_kept(percent), "a long, b long, weight long"),
        "join-candidates")
    return write_out(spark, matching(left, texts, shingle_set, lambda x, y: links(x, y, percent)), "join-links")


def _forest(r1: np.ndarray, r2: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Places of the pairs of components that make a least spanning forest by ``apart``."""
    names, ends = np.unique(np.concatenate((r1, r2)), return_inverse=True)
    order = np.argsort(apart, kind="stable")
    a, b = ends[:len(r1)][order], ends[len(r1):][order]
    tree, left, taken = np.arange(len(names)), np.arange(len(order)), [np.zeros(0, dtype=np.int64)]
    while True:
        left = left[tree[a[left]] != tree[b[left]]]
        if not len(left):
            return order[np.concatenate(taken)]
        # each tree takes its closest pair; of equally close ones the first, so that no circle comes about
        closest = np.full(len(names), len(order))
        np.minimum.at(closest, tree[a[left]], left)
        np.minimum.at(closest, tree[b[left]], left)
        picked = np.unique(closest[closest < len(order)])
        taken.append(picked)
        into = list(range(len(names)))

        def root(i: int, into: list[int] = into) -> int:
            while into[i] != i:
                into[i] = into[into[i]]
                i = into[i]
            return i

        for i, j in zip(tree[a[picked]].tolist(), tree[b[picked]].tolist(), strict=True):
            into[root(i)] = root(j)
        tree = np.array([root(i) for i in range(len(into))])[tree]


def _open_pairs(percent: int, forest: bool):
    """A group of lists, or two blocks of one -> pairs of different components that pass all filters.

    ``forest``: only those of a least spanning forest of the components.
    """
    def run(table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).to_numpy()
        order = np.argsort(column("token"), kind="stable")
        token, block, node, root, size, pos = (column(c)[order] for c in ("token", "block", "node", "root", "size", "pos"))
        size, pos = size.astype(np.int64), pos.astype(np.int64)
        low, high = int(column("low")[0]), int(column("high")[0])
        counts = _counts(table.column("counts").to_pylist())[order]
        cuts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1], [True])))
        found = [np.zeros((0, 3), dtype=np.int64)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            left = np.arange(s, e)[block[s:e] == low]
            right = left if low == high else np.arange(s, e)[block[s:e] == high]
            for k in range(0, len(left), 64):
                i, j = left[k:k + 64, None], right[None, :]
                least = needed(size[i], size[j], percent)
                ok = (root[i] != root[j]) & (np.minimum(size[i] - pos[i], size[j] - pos[j]) >= least)
                ok &= np.minimum(size[i], size[j]) * 100 >= np.maximum(size[i], size[j]) * percent
                if low == high:
                    ok &= node[i] > node[j]
                x, y = np.nonzero(ok)
                if not len(x):
                    continue
                x, y = left[k + x], right[y]
                apart = np.abs(counts[x] - counts[y]).sum(axis=1)
                keep = apart <= size[x] + size[y] - 2 * needed(size[x], size[y], percent)
                found.append(np.stack((x[keep], y[keep], apart[keep]), axis=1))
        x, y, apart = np.concatenate(found).T
        swap = node[x] < node[y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        r1, r2 = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        first = np.lexsort((node[y], node[x], apart, r2, r1) if forest else (node[y], node[x]))
        x, y, apart, r1, r2 = (v[first] for v in (x, y, apart, r1, r2))
        same = (r1[1:] == r1[:-1]) & (r2[1:] == r2[:-1])
        if not forest:
            same = (node[x][1:] == node[x][:-1]) & (node[y][1:] == node[y][:-1])
        one = np.flatnonzero(np.concatenate(([True], ~same))[:len(x)])
        if forest:
            one = one[_forest(r1[one], r2[one], apart[one])]
        return pa.table({c: pa.array(v[one].astype(np.int64)) for c, v in (
            ("a", node[x]), ("b", node[y]), ("r1", r1), ("r2", r2), ("apart", apart))})
    return run


def _open_candidates(members: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int, turn: str) -> DataFrame:
    """(a, b) of different components in lists whose texts lie in several components.

    ``turn``: "within" short lists and single blocks, "across" different blocks, or "all" pairs that are left.
    """
    now = rooted(members.select("token", "node", "size", "pos"), "node", roots)
    lists = (now.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("n"))
             .where("r1 <> r2").select("token", "n"))
    rows = write_out(now.sparkSession, now.join(lists, "token"), "join-open")
    groups = max(1, -(-rows.where(F.col("n") <= BLOCK).count() // GROUP_ROWS))
    short = rows.where(F.col("n") <= BLOCK).select(
        F.pmod(F.xxhash64("token"), F.lit(groups)).alias("part"), F.lit(-1).cast("long").alias("low"),
        F.lit(-1).cast("long").alias("high"), F.lit(-1).cast("long").alias("block"), "token", "node", "root", "size", "pos")
    # blocks of a long list: a size class and a salt; a block meets those of its class and of the next one
    long = rows.where(F.col("n") > BLOCK).withColumn("of", _size_class(F.col("size"), percent))
    salts = (long.groupBy("token", "of").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("salts")))
    number = lambda of, salt: of.cast("long") * (1 << 32) + salt
    others = salts.select("token", "of", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    partner = others.select("token", F.explode(F.array(F.col("of") - 1, F.col("of"), F.col("of") + 1)).alias("of"),
                            number(F.col("of"), F.col("salt")).alias("other"))
    dealt = (long.join(salts, ["token", "of"])
             .withColumn("block", number(F.col("of"), F.pmod(F.xxhash64("node"), F.col("salts"))))
             .join(partner, ["token", "of"])
             .select(F.col("token").alias("part"), F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high"), "block", "token", "node", "root", "size", "pos"))
    met = {"within": short.unionAll(dealt.where("low = high")), "across": dealt.where("low <> high"),
           "all": short.unionAll(dealt)}[turn]
    pairs = met.join(nodes.select("node", "counts"), "node").groupBy("part", "low", "high").applyInArrow(
        _open_pairs(percent, turn != "all"), "a long, b long, r1 long, r2 long, apart long")
    if turn == "all":
        return pairs.select("a", "b").distinct()
    return pairs.groupBy("r1", "r2").agg(F.min(F.struct("apart", "a", "b")).alias("x")).select("x.a", "x.b")


def rooted(rows: DataFrame, column: str, roots: DataFrame, out: str = "root") -> DataFrame:
    """``rows`` with the root of ``column`` (itself where it has none) added."""
    found = roots.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    return (rows.join(found, F.col(column) == F.col("__n"), "left")
            .withColumn(out, F.coalesce("__r", column)).drop("__n", "__r"))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after further links: only the components that these join are worked out anew, as nodes of their own."""
    between = rooted(rooted(links, "a", roots, "ra"), "b", roots, "rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    joined = write_out(roots.sparkSession, components(between.distinct()), "join-merged")
    every = roots.select("node", "root").unionAll(joined.select("node", F.col("node").alias("root"))).distinct()
    now = joined.select(F.col("node").alias("__old"), F.col("root").alias("__new"))
    return write_out(roots.sparkSession, every.join(now, F.col("root") == F.col("__old"), "left")
                     .select("node", F.coalesce("__new", "root").alias("root")), "join-roots")


def _texts(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(node, text) of all members, written: a bitmap drops most other texts where they are read."""
    keys = write_out(docs.sparkSession, members.select("node").distinct().join(nodes.select("node", "key"), "node"),
                     "join-keys")
    shared = docs.sparkSession.sparkContext.broadcast(_marks(keys.select(F.xxhash64("key").alias("h"))))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            hit = _hit(marks, batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2)], names=["key", "text"]).filter(pa.array(hit))

    some = (docs.where(F.col("key").isNotNull()).select(F.xxhash64("key").alias("h"), "key", "text")
            .mapInArrow(marked, "key binary, text string"))
    return write_out(docs.sparkSession, some.join(keys, "key").groupBy("node").agg(F.first("text").alias("text")),
                     "join-texts")


def connected(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """For (key, text): the written nodes (key, node, size, ...), and (node, root) of the nodes that link to another."""
    spark = docs.sparkSession
    made = docs.where(F.col("key").isNotNull()).mapInArrow(
        _sketched(percent), "key binary, size int, ranked array<long>, more array<long>, counts binary")
    nodes = made.groupBy("key").agg(*[F.first(c).alias(c) for c in ("size", "ranked", "more", "counts")])
    nodes = write_out(spark, nodes.withColumn("node", F.monotonically_increasing_id()), "join-nodes")
    posted = write_out(spark, prefixes(nodes, percent), "join-prefixes")
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token")
    members = write_out(spark, posted.join(shared, "token"), "join-members")
    texts = _texts(docs, nodes, members)
    # each list's least text is met by the others of its size class
    classed = members.withColumn("of", _size_class(F.col("size"), percent))
    centre = classed.groupBy("token", "of").agg(F.min(F.struct("node", "size", "pos")).alias("c"))
    star = (classed.join(centre, ["token", "of"]).where("node <> c.node")
            .where(_possible(F.col("size"), F.col("c.size"), F.col("pos"), F.col("c.pos"), percent))
            .groupBy(F.col("node").alias("a"), F.col("c.node").alias("b")).agg(F.count(F.lit(1)).alias("common")))
    star = write_out(spark, star, "join-star")
    best = star.groupBy("a").agg(F.max(F.struct("common", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    compared = write_out(spark, best, "join-first")
    roots = components(verified(compared, nodes, texts, percent))

    def between(pairs: DataFrame) -> DataFrame:
        both = rooted(rooted(pairs, "a", roots, "ra"), "b", roots, "rb")
        return both.where("ra <> rb").select("a", "b")

    def compare(pairs: DataFrame) -> None:
        nonlocal compared, roots
        left = write_out(spark, pairs.join(compared, ["a", "b"], "left_anti"), "join-pairs")
        more = verified(left, nodes, texts, percent)
        compared = compared.unionAll(left)
        if not more.isEmpty():
            roots = _merged(roots, more)

    compare(between(star.select("a", "b")))
    for turn in ("within", "across", "all"):
        compare(_open_candidates(members, nodes, roots, percent, turn))
    return nodes, roots


def assign(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``df``."""
    text = quoted(text_col).cast("string")
    docs = df.select(quoted(id_col).alias("doc_id"), node_key(text).alias("key"), text.alias("text"))
    nodes, roots = connected(docs.select("key", "text"), percent)
    least = docs.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("least"))
    placed = write_out(df.sparkSession, rooted(nodes.select("key", "node", "size").join(least, "key"), "node", roots),
                       "join-placed")
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    held = placed.join(ids, "root").select(F.col("key").alias("__k"), "size", "component_id")
    return (docs.select("doc_id", "key").join(held, F.col("key") == F.col("__k"), "left")
            .select("doc_id", F.coalesce("size", F.lit(0)).cast("long").alias("n_shingles"),
                    F.when(F.col("__k").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
