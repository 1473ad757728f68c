"""The registered queries of this subpackage: name -> query(spark, sf_dir), and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (bloomlm, bpe, centroids, codes, gam, mixing, neardup, ngramjoin, pagetext, rules, topk,
                           toxicity, urls)
from tributary.llm.common import crc_mod
from tributary.session import prepare
from tributary.sources.tables import read_table

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}

VOCAB = "byte_bpe_multi_50k.tiktoken"


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by byte-level BPE, decoded again; digests of both."""
    import public_tokenizers

    path = public_tokenizers.path(VOCAB)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, "text", path, public_tokenizers.PATTERN).drop("text")
    back = bpe.decode(coded, "ids", path)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text by the additive model; labels of every fifth id (by crc32) are held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = gam.train(docs, read_table(spark, sf_dir, "labels"), "quality", crc_mod(F.col("doc_id"), 5) != 0)
    return (docs.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
                        gam.score_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


@query
def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, the base rules, and the verdict of thresholds per language and source."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return rules.judge(docs, keep_text=False).select("doc_id", *rules.COUNTS, "base_failed", "kept")


ORACLE_SQL["op2_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, lang, source FROM documents),
w AS (
  SELECT r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
win AS (
  SELECT r, i, array_to_string(w[i + 1:i + 8], ' ') AS win
  FROM (SELECT r, w, unnest(range(len(w) - 7)) AS i FROM w WHERE len(w) >= 8)),
dup AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM dup) GROUP BY r),
ln AS (
  SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
c AS (
  SELECT d.r, d.doc_id, d.lang, d.source, len(w.w) AS n_words,
         length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(ln.l) - len(list_distinct(ln.l)) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN w USING (r) JOIN ln USING (r) LEFT JOIN rep USING (r)),
s AS (
  SELECT r, lang, source, unnest(['symbols', 'dup_lines', 'chars']) AS signal,
         unnest([n_symbols * 1000 // n_words, n_dup_lines * 1000 // n_words, word_chars * 1000 // n_words]) AS v
  FROM c WHERE n_words > 0),
b AS (
  SELECT lang, source, signal, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS bucket,
         count(*) AS n
  FROM s GROUP BY ALL),
q AS (
  SELECT lang, source, signal, min(bucket) FILTER (upto * 4 >= total) AS q1,
         min(bucket) FILTER (upto * 4 >= total * 3) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, signal) AS total,
               sum(n) OVER (PARTITION BY lang, source, signal ORDER BY bucket) AS upto FROM b) GROUP BY ALL),
f AS (
  SELECT lang, source, signal, q1 - 3 * greatest(q3 - q1, fl) AS low, q3 + 3 * greatest(q3 - q1, fl) AS high
  FROM q JOIN (VALUES ('symbols', 50), ('dup_lines', 30), ('chars', 700)) AS t(signal, fl) USING (signal)),
o AS (
  SELECT DISTINCT s.r FROM s JOIN f ON s.signal = f.signal AND s.lang IS NOT DISTINCT FROM f.lang
    AND s.source IS NOT DISTINCT FROM f.source
  WHERE s.v > f.high OR (s.signal = 'chars' AND s.v < f.low))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND o.r IS NULL AS kept
FROM c LEFT JOIN o USING (r)
"""


# The rules of the contract (host, path, verdict).
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query
def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, "url", URL_RULES).drop("url")


ORACLE_SQL["op7_urls"] = r"""
WITH u AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT r, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
         ('org', '/fr/', 'allow')),
fit AS (
  SELECT p.r, x.host || x.path AS rule, x.verdict,
         row_number() OVER (PARTITION BY p.r ORDER BY length(x.host || x.path) DESC, length(x.host) DESC) AS k
  FROM p JOIN rules x ON (p.host = x.host OR ends_with(p.host, '.' || x.host)) AND starts_with(p.path, x.path))
SELECT p.page_id, p.host, p.path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict
FROM p LEFT JOIN fit ON p.r = fit.r AND fit.k = 1
"""


@query
def op10_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors of highest whole-number inner product for each row whose id is divisible by 50."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.search(vectors, "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5, scale=256.0)


ORACLE_SQL["op10_maxscore"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document so that each source comes to its target."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.taken(docs).select("doc_id", "size", "source_size", "target",
                                     (F.col("size") * F.col("copies")).alias("taken"))


@query
def op3_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return neardup.assign(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by the recurrent network; labels of every third id (by crc32) are held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.train(docs, read_table(spark, sf_dir, "labels"), "toxic", crc_mod(F.col("doc_id"), 3) != 1)
    shared = spark.sparkContext.broadcast(net)
    return (docs.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"),
                        toxicity.score_column(shared, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.7).cast("int")))


@query
def op6_bloomlm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact add-one score and Bloom filter score of every text; every seventh id (by crc32) is held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    model = bloomlm.train(docs, "text", ~held_out)
    return (bloomlm.score(docs, "text", model)
            .select("doc_id", held_out.alias("held_out"), *bloomlm.ADDED))


@query
def op5_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return (pagetext.extract(pages, "html", "text").drop("html")
            .withColumn("n_chars", F.length("text").cast("long")))


@query
def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors by four codebooks of at most 256 entries, their errors, and the codebooks' digest."""
    coded, books = codes.encode(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return (coded.withColumnRenamed("id", "vec_id").drop("label")
            .withColumn("codebooks_sha256", F.lit(codes.codebooks_digest(books))))


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Lloyd rounds written out; all sums are of whole numbers within a double."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, p, CAST(least % {entries} AS INT) AS e, least // {entries} AS d FROM (
    SELECT q.r, q.p, min(CAST(q.xx - 2 * list_dot_product(q.x, b.x) + list_dot_product(b.x, b.x) AS BIGINT) * {entries} + b.e)
           AS least
    FROM q JOIN b{k} b ON q.p = b.p GROUP BY q.r, q.p)),""")
        if k < rounds:
            steps.append(f"""
m{k} AS MATERIALIZED (
  SELECT p, e, list(floor(s / n) ORDER BY i) AS x FROM (
    SELECT p, e, i, sum(v) AS s, count(*) AS n FROM (
      SELECT a.p, a.e, unnest(q.x) AS v, generate_subscripts(q.x, 1) AS i FROM a{k} a JOIN q ON a.r = q.r AND a.p = q.p)
    GROUP BY p, e, i) GROUP BY p, e),
b{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m ON b.p = m.p AND b.e = m.e),""")
    code = " || ".join(f"printf('%02x', max(e) FILTER (p = {p}))" for p in range(parts))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS MATERIALIZED (
  SELECT *, list_dot_product(x, x) AS xx FROM (
    SELECT r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x
    FROM kept, (SELECT unnest(range({parts})) AS p))),
b0 AS MATERIALIZED (SELECT p, CAST(r - 1 AS INT) AS e, x FROM q WHERE r <= {entries}),{"".join(steps)}
c AS (SELECT r, {code} AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
h AS (
  SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS h FROM (
    SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM b{rounds}))
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       h.h AS codebooks_sha256
FROM kept k JOIN c USING (r), h
"""


ORACLE_SQL["op11_codes"] = _codes_sql()


@query
def op12_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of all vectors of 64 components, by subvector dictionaries."""
    found, points = centroids.cluster(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return centroids.report(found, points).withColumnRenamed("id", "vec_id")


def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, CAST(least % {k} AS INT) AS c, least // {k} AS d FROM (
    SELECT v.r, min(CAST(v.xx - 2 * list_dot_product(v.x, b.x) + list_dot_product(b.x, b.x) AS BIGINT) * {k} + b.c) AS least
    FROM v, b{i} b GROUP BY v.r)),""")
        if i < rounds:
            steps.append(f"""
m{i} AS MATERIALIZED (
  SELECT c, list(floor(s / n) ORDER BY i) AS x FROM (
    SELECT c, i, sum(x) AS s, count(*) AS n FROM (
      SELECT a.c, unnest(v.x) AS x, generate_subscripts(v.x, 1) AS i FROM a{i} a JOIN v USING (r)) GROUP BY c, i)
  GROUP BY c),
b{i + 1} AS MATERIALIZED (SELECT b.c, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m USING (c)),""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT *, list_dot_product(x, x) AS xx FROM (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) AS r, vec_id,
           list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x
    FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
b0 AS MATERIALIZED (SELECT CAST(r - 1 AS INT) AS c, x FROM v WHERE r <= {k}),{"".join(steps)}
h AS (
  SELECT c, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS h FROM (
    SELECT c, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM b{rounds}) GROUP BY c)
SELECT v.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256
FROM v JOIN a{rounds} a USING (r) JOIN h ON h.c = a.c
"""


ORACLE_SQL["op12_dictionaries"] = _clusters_sql()


@query
def op13_ngramjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document; links are a Jaccard similarity of 0.9 of three-word shingles."""
    return ngramjoin.assign(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE_SQL["op13_ngramjoin"] = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM w),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
common AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
link AS MATERIALIZED (
  SELECT a, b FROM common c JOIN n x ON x.r = c.a JOIN n y ON y.r = c.b WHERE 100 * c.c >= 90 * (x.n + y.n - c.c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (
  SELECT r, r FROM w
  UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (r)
JOIN (SELECT reach.a AS r, min(o.doc_id) AS component_id FROM reach JOIN w o ON o.r = reach.b GROUP BY reach.a) c USING (r)
"""
