"""Byte-level BPE by overlapping chunk encoding, and decoding.

A text is cut into chunks of ``chunk`` code points, each followed by
``overlap`` code points of the next.  Chunks of all texts are pre-tokenised
and encoded in parallel, each from its own first character on.  A chunk after
the first may begin inside a pre-token, so its first pieces can be wrong; but
what the pattern matches at a position depends only on the text from there
on, so from the first position where the pieces of two neighbouring chunks
begin together (the chunks "resynchronise") both agree.  Stitching takes a
chunk's pieces up to that position and its neighbour's from there.  Only the
pieces inside the overlaps travel with a chunk's ids.  A text in which two
chunks never meet (one pre-token longer than the overlap) is encoded whole.

Texts of at most one chunk need no stitching and no shuffle.

Defined results: a null or empty text has no ids and decodes to no bytes; a text
of any length is encoded whole; of pieces that could be joined in several ways
the lowest rank is joined first, the leftmost among equals; repeated rows are
encoded alike; an empty table gives an empty table; ids that the vocabulary
lacks cannot be decoded and raise.  A lone byte that is no UTF-8 comes back as
the same byte.  Extra columns stay, whatever their names (an input column of the
output's name is replaced).
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import fresh, map_arrow, quoted

CHUNK = 16_384
OVERLAP = 1_024
MAX_CHUNKS = 64          # longer texts get longer chunks, not more of them
CACHED_PIECES = 120_000  # per worker; a full cache starts anew
ROWS = 64                # rows worked on at once in a worker
DECODED = 1 << 18        # ids turned into bytes at once


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, of a vocabulary file in the tiktoken format."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PieceIds(dict):
    """Pre-token -> its ids as int32 bytes, filled on first use; the joining of byte pairs is compiled code."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        import tiktoken
        self._join = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks,
                                       special_tokens={})._core_bpe.encode_single_piece

    def __missing__(self, piece: str) -> bytes:
        out = array("i", self._join(piece.encode("utf-8"))).tobytes()
        if len(piece) <= 64:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = out
        return out


@lru_cache(maxsize=2)
def codec(path: str, pattern: str):
    """(compiled pattern, piece ids), once per worker."""
    import regex
    return regex.compile(pattern), PieceIds(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def token_bytes(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


def _lists(blobs: list[bytes]) -> pa.Array:
    """int32 lists from their raw bytes."""
    ends = np.cumsum([0] + [len(b) // 4 for b in blobs], dtype=np.int64)
    flat = np.frombuffer(b"".join(blobs), dtype=np.int32)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat)).cast(pa.list_(pa.int32()))


def _encode_batches(at: int, path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, pieces = codec(path, pattern)
        find, get = compiled.findall, pieces.__getitem__
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                ids = _lists([b"".join(map(get, find(t))) if t else b"" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*batch.schema.names, "__ids"])
    return run


def _encode_chunks(path: str, pattern: str, overlap: int):
    """(uid, cno, step, last, text) -> the chunk's ids, and by piece of the head (its first ``overlap`` code points)
    and of the tail (what the next chunk begins with): its place, counted from the later chunk's start, and how many
    ids stand before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, pieces = codec(path, pattern)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                step, last, text = (row.column(j)[0].as_py() for j in (2, 3, 4))
                found = [(m.start(), pieces[m.group()]) for m in compiled.finditer(text)]
                at = np.array([a for a, _ in found], dtype=np.int32)
                before = np.cumsum([0] + [len(b) // 4 for _, b in found], dtype=np.int32)[:-1]
                head = at <= overlap
                # the last two pieces may change with what follows the chunk's end
                tail = (at >= step) & (np.arange(len(at)) < len(at) - 2) & (not last)
                made = [at[head], before[head], at[tail] - step, before[tail]]
                ids = np.frombuffer(b"".join([b for _, b in found]), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [row.column(0), row.column(1), pa.array([text if last else text[:step]]),
                     *[pa.array([x.tobytes()], type=pa.binary()) for x in made],
                     pa.array([_packed(ids)], type=pa.binary())],
                    names=["uid", "cno", "own", "head", "head_ids", "tail", "tail_ids", "ids"])
    return run


def _packed(ids: np.ndarray) -> bytes:
    """Ids in two bytes each where all fit, else in four; the first byte says which."""
    small = not len(ids) or ids.max() < 1 << 16
    return (b"2" + ids.astype("<u2").tobytes()) if small else (b"4" + ids.astype("<i4").tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype="<u2" if blob[:1] == b"2" else "<i4", offset=1)


def stitch(chunks: list[tuple]) -> np.ndarray | None:
    """Ids of a whole text from its chunks in order: (head, head_ids, tail, tail_ids, ids); None if two never meet."""
    out, begin = [], 0
    for this, later in zip(chunks[:-1], chunks[1:], strict=True):
        met, i, j = np.intersect1d(this[2], later[0], assume_unique=True, return_indices=True)
        if not len(met):
            return None
        out.append(this[4][begin:this[3][i[0]]])
        begin = later[1][j[0]]
    return np.concatenate([*out, chunks[-1][4][begin:]]).astype(np.int32)


def _stitch_group(path: str, pattern: str):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("cno")
        rows = table.select(["head", "head_ids", "tail", "tail_ids", "ids"]).to_pydict()
        ids = stitch([(*[np.frombuffer(x, dtype=np.int32) for x in r[:-1]], _unpacked(r[-1]))
                      for r in zip(*rows.values(), strict=True)])
        if ids is None:
            compiled, pieces = codec(path, pattern)
            text = "".join(table.column("own").to_pylist())
            ids = np.frombuffer(b"".join([pieces[m.group()] for m in compiled.finditer(text)]), dtype=np.int32)
        return pa.table({"__uid": table.column("uid").slice(0, 1),
                         "__ids": pa.array([ids], type=pa.list_(pa.int32()))})
    return run


def encode(df: DataFrame, text_col: str, vocab: str, pattern: str, out_col: str = "ids",
           chunk: int = CHUNK, overlap: int = OVERLAP, decoded_col: str | None = None) -> DataFrame:
    """``df`` with the ids of each text added as ``out_col`` (array<int>).

    ``vocab`` is a vocabulary file that every worker can open (installed with
    the tokenizer package).  An input column of the name ``out_col`` is replaced.
    With ``decoded_col`` the result is that of ``decode`` over it, with that name;
    one Python worker a task then does both, not one each.
    """
    df = df.select(*[quoted(c) for c in df.columns if c.lower() not in {out_col.lower(), (decoded_col or out_col).lower()}])
    names = df.columns
    uid, key, ids, raw = (fresh(names, c) for c in ("__uid", "__key", "__ids", "__raw"))
    if text_col not in names:
        raise ValueError(f"no column {text_col!r}")
    text = quoted(text_col)
    if chunk <= overlap:
        raise ValueError("a chunk must be longer than the overlap")
    short = df.where(text.isNull() | (F.length(text) <= chunk + overlap))
    batches, added = _encode_batches(names.index(text_col), vocab, pattern), f"{ids} array<int>"
    if decoded_col:
        batches, added = _in_turn(batches, _decode_batches(len(names), vocab)), f"{added}, {raw} binary"
    done = map_arrow(short, batches, added)
    # ids by partition and row: the same whenever a lost task runs again over its split
    numbered = df.withColumn(uid, F.monotonically_increasing_id())
    long_rows = numbered.where(F.length(text) > chunk + overlap)
    step = F.greatest(F.lit(chunk), F.ceil(F.length(text) / MAX_CHUNKS)).cast("int")
    parts = (long_rows.select(quoted(uid).alias("uid"), text.alias("text"), step.alias("step"),
                              F.ceil((F.length(text) - overlap) / step).cast("int").alias("n"))
             .select("uid", "text", "step", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("cno"))
             .select("uid", "cno", "step", (F.col("cno") == F.col("n") - 1).alias("last"),
                     F.substring("text", F.col("cno") * F.col("step") + 1,
                                 F.col("step") + F.lit(overlap)).alias("text"))
             .repartition(F.col("uid"), F.col("cno"))
             .mapInArrow(_encode_chunks(vocab, pattern, overlap),
                         "uid long, cno int, own string, head binary, head_ids binary, tail binary, tail_ids binary,"
                         " ids binary"))
    whole = parts.groupBy("uid").applyInArrow(_stitch_group(vocab, pattern), "__uid long, __ids array<int>")
    whole = whole.select(F.col("__uid").alias(key), F.col("__ids").alias(ids))
    joined = long_rows.join(whole, quoted(uid) == quoted(key)).select(*[quoted(c) for c in names], quoted(ids))
    if not decoded_col:
        return done.unionAll(joined).toDF(*names, out_col)
    return done.unionAll(decode(joined, ids, vocab, raw)).toDF(*names, out_col, decoded_col)


def _in_turn(first, then):
    return lambda batches: then(first(batches))


def _decode_batches(at: int, vocab: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = token_bytes(vocab).__getitem__

        def raw(ids: pa.Array | None) -> bytes:
            if ids is None:
                return b""
            try:
                return b"".join([b"".join(map(get, ids.slice(k, DECODED).to_numpy(zero_copy_only=False).tolist()))
                                 for k in range(0, len(ids), DECODED)])
            except KeyError as exc:
                raise ValueError(f"id {exc.args[0]} is not in the vocabulary") from exc

        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                out = pa.array([raw(x.values) for x in part.column(at)], type=pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*batch.schema.names, "__raw"])
    return run


def decode(df: DataFrame, ids_col: str, vocab: str, out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of each id list added as ``out_col``: the tokens' raw bytes, one after another."""
    df = df.select(*[quoted(c) for c in df.columns if c.lower() != out_col.lower()])
    raw = fresh(df.columns, "__raw")
    out = map_arrow(df, _decode_batches(df.columns.index(ids_col), vocab), f"{raw} binary")
    return out.toDF(*df.columns, out_col)
