"""URL filter over a sorted digest array.

A list of rules (host, path, verdict) becomes one file: the 64-bit xxhash of
every rule's string in rising order, where each string begins, its verdict,
and the strings themselves.  Spark's ``addFile`` hands the file to every
executor (also to one that replaces a lost one); workers memory-map it, so its
pages are shared by the workers of a machine.  A batch of urls is probed at
once: the strings of all rules that could fit a url (host suffixes by path
beginnings, of the label counts and lengths that the list has) are hashed and
looked up by binary search, and a hit counts only if the stored string is
equal.

A rule fits its host and all subdomains if the url's path begins with the
rule's.  Of several the longest wins (host and path together; then the longer
host).  A url that no rule fits is allowed.

Defined results: null, empty and malformed urls (no ``://``) have an empty
host and path, fit no rule and are allowed; a url of any length is judged whole;
an empty table gives an empty table; repeated rows are judged alike; extra
columns stay, but those named host, path, rule or verdict are replaced.  Of
repeated rules for one host and path, the last given holds.
"""

from __future__ import annotations

import os
import string
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import map_arrow, quoted

ALLOW, BLOCK = "allow", "block"
ROWS = 1024          # urls probed at once
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

Rule = tuple[str, str, str]


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host after the first ``://``, lower-cased (A-Z only), the path up to ``?`` or ``#``."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for mark in "?#":
        rest = rest.split(mark, 1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def write_list(rules: Iterable[Rule], path: str) -> None:
    """Write the digest array of ``rules``; each path begins with a slash."""
    last = {}
    for host, rule_path, verdict in rules:
        if not host or not rule_path.startswith("/") or verdict not in (ALLOW, BLOCK):
            raise ValueError(f"no rule: {(host, rule_path, verdict)!r}")
        last[(host.translate(_LOWER) + rule_path).encode()] = verdict
    ranked = sorted((xxhash.xxh64_intdigest(s), s, v) for s, v in last.items())
    blob = b"".join(s for _, s, _ in ranked)
    ends = np.cumsum([0] + [len(s) for _, s, _ in ranked], dtype=np.uint64)
    with open(path, "wb") as f:
        np.array([len(ranked), len(blob)], dtype=np.uint64).tofile(f)
        np.array([h for h, _, _ in ranked], dtype=np.uint64).tofile(f)
        ends.tofile(f)
        np.array([v == BLOCK for _, _, v in ranked], dtype=np.uint8).tofile(f)
        f.write(blob)


class DigestList:
    """The memory-mapped list of one file."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype=np.uint8, mode="r")
        n, size = (int(x) for x in data[:16].view(np.uint64))
        at = 16
        self.keys = data[at:at + 8 * n].view(np.uint64)
        self.ends = data[at + 8 * n:at + 16 * n + 8].view(np.uint64)
        self.block = data[at + 16 * n + 8:at + 17 * n + 8]
        self.blob = data[at + 17 * n + 8:at + 17 * n + 8 + size]
        labels, lengths = set(), set()
        for i in range(n):
            host, _, rest = self.string(i).decode().partition("/")
            labels.add(host.count(".") + 1)
            lengths.add(len(rest) + 1)
        self.labels, self.lengths = sorted(labels), sorted(lengths)

    def string(self, i: int) -> bytes:
        return self.blob[int(self.ends[i]):int(self.ends[i + 1])].tobytes()

    def candidates(self, host: str, path: str) -> list[bytes]:
        """Strings of all rules that could fit, by falling length."""
        if not host or not path:
            return []
        parts = host.rsplit(".", max(self.labels, default=0))
        hosts = [".".join(parts[-k:]) for k in self.labels if k <= host.count(".") + 1]
        found = [(len(h) + n, len(h), h + path[:n]) for h in hosts for n in self.lengths if n <= len(path)]
        return [s.encode() for _, _, s in sorted(found, reverse=True)]

    def find(self, urls: list[tuple[str, str]]) -> list[int]:
        """The position of each url's rule in the list, or -1."""
        tried = [self.candidates(*u) for u in urls]
        flat = [s for c in tried for s in c]
        hashes = np.array([xxhash.xxh64_intdigest(s) for s in flat], dtype=np.uint64)
        at = np.searchsorted(self.keys, hashes)
        hit = (at < len(self.keys)) & (self.keys[np.minimum(at, max(0, len(self.keys) - 1))] == hashes) \
            if len(self.keys) else np.zeros(len(flat), dtype=bool)
        out, k = [], 0
        for c in tried:
            rule = -1
            for j in range(k, k + len(c)):
                if hit[j] and rule < 0:
                    i = int(at[j])
                    while i < len(self.keys) and self.keys[i] == hashes[j]:   # equal hashes of different strings
                        if self.string(i) == flat[j]:
                            rule = i
                            break
                        i += 1
            out.append(rule)
            k += len(c)
        return out


@lru_cache(maxsize=4)
def _mapped(path: str) -> DigestList:
    return DigestList(path)


def _judge_batches(at: int, file_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = _mapped(SparkFiles.get(file_name))
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                urls = [split_url(u) for u in part.column(at).to_pylist()]
                rules = listed.find(urls)
                added = [pa.array([h for h, _ in urls], type=pa.string()),
                         pa.array([p for _, p in urls], type=pa.string()),
                         pa.array([None if i < 0 else listed.string(i).decode() for i in rules], type=pa.string()),
                         pa.array([BLOCK if i >= 0 and listed.block[i] else ALLOW for i in rules], type=pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added],
                                                 names=[*batch.schema.names, "host", "path", "rule", "verdict"])
    return run


def judge(df: DataFrame, url_col: str, rules: Iterable[Rule]) -> DataFrame:
    """``df`` with host, path, rule (null: none fits) and verdict of each url added.

    The list is a parameter that the caller holds in memory; it does not grow
    with the data.
    """
    added = ("host", "path", "rule", "verdict")
    if url_col.lower() in added:
        raise ValueError(f"the url column may not be named {url_col!r}")
    df = df.select(*[quoted(c) for c in df.columns if c.lower() not in added])
    name = f"url-rules-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="url-rules-"), name)
    write_list(rules, path)
    df.sparkSession.sparkContext.addFile(path)
    return map_arrow(df, _judge_batches(df.columns.index(url_col), name),
                     ", ".join(f"{c} string" for c in added))


def blocked(judged: DataFrame) -> DataFrame:
    """The rows of ``judge`` whose verdict is block."""
    return judged.where(F.col("verdict") == BLOCK)
