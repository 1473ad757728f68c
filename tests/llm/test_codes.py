import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import codes, queries, vectors
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(rows (id, code, error, label_error) sorted, digest) by plain loops over whole numbers."""
    ok = [(i, [max(-vectors.BOUND, min(vectors.BOUND, math.floor(scale * float(np.float32(x))))) for x in v], label)
          for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = max((len(v) for _, v, _ in ok), default=0)
    width = max(1, -(-longest // parts))
    ok = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in ok]
    ordered = sorted(ok, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in ordered[:entries]] for p in range(parts)]

    def place(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for _, v, _ in ok:
                members.setdefault(place(cut(v, p), book)[1], []).append(cut(v, p))
            for k, xs in members.items():
                book[k] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = [], {}
    for i, v, label in ok:
        found = [place(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(n) for b in books for e in b for n in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label]) for i, c, e, label in out), key=str), digest


def run(spark, rows, **more):
    coded, books = codes.encode(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label", **more)
    assert coded.columns == ["id", "label", "code", "error", "label_error"]
    return (sorted(((r.id, r.code, r.error, r.label_error) for r in coded.collect()), key=str),
            codes.codebooks_digest(books))


def rows_of(n, dims, seed, copies=0):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(0, 0.2) for _ in range(dims)], i % 3) for i in range(n)]
    return out + [(n + i, out[7][1], None) for i in range(copies)]


def test_equals_plain_lloyd_and_moves_only_what_changes(spark, monkeypatch):
    moved, kept = [], codes.Members.migrate

    def migrate(self, salts):
        moved.append((self.table().where("goes <> entry").count(), self.residents().count()))
        kept(self, salts)
        assert self.residents().count() == sum(moved[-1])
        # a resident's bucket is its owner's: the table is read by owner without a shuffle
        plan = codes.owner_sums(self.residents(), 2)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan

    monkeypatch.setattr(codes.Members, "migrate", migrate)
    rows = rows_of(300, 8, 1)
    assert run(spark, rows, entries=16) == brute(rows, entries=16)
    assert moved and all(m < stay for m, stay in moved)


def test_a_hot_entry_is_dealt_over_owners(spark, monkeypatch):
    seen = []
    made = codes._salts
    monkeypatch.setattr(codes, "_salts", lambda *a: seen.append(made(*a)) or seen[-1])
    rows = rows_of(120, 8, 2, copies=200)
    assert run(spark, rows, entries=10, owner_rows=20) == brute(rows, entries=10)
    assert seen[0].max() >= 10 and all((a <= b).all() for a, b in zip(seen, seen[1:]))


def test_odd_rows(spark):
    rows = rows_of(20, 8, 3) + [
        (100, None, 1), (101, [1.0, None] * 4, 1), (102, [float("nan")] * 8, 1), (103, [float("inf")] * 8, 1),
        (None, [0.5] * 8, 2), (None, [0.25] * 8, None), (3, [0.1] * 8, 0), (3, [0.1] * 8, 0), (104, [], 1),
        (105, [1.0, 2.0, 3.0], 1), (106, [1e30, -1e30] * 4, 2)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, entries=5, rounds=2, parts=3) == brute(rows, entries=5, rounds=2, parts=3)


def test_empty_tables_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert codes.encode(empty, "vec_id", "embedding", "label")[0].count() == 0
    nulls = spark.createDataFrame([(1, None, 1)], SCHEMA)
    assert codes.encode(nulls, "vec_id", "embedding", "label")[0].count() == 0
    rows = rows_of(30, 4, 4)
    names = ["id", "uid", "v", "x", "goes", "entry", "position", "salt", "of", "code", "a.b", "n"]
    wide = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in names])
    out = codes.encode(wide, "vec_id", "embedding", "label")[0]
    assert sorted(((r.id, r.code, r.error, r.label_error) for r in out.collect()), key=str) == brute(rows)[0]


@pytest.mark.parametrize("name", ["op11_codes", "op12_dictionaries"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
