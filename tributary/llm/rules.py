"""Quality rules with adaptive thresholds, in DataFrame functions only.

Signals of a text are whole numbers, so both passes and any rerun agree to the
last bit.  Rates are given per ``SCALE`` words:

* symbols: characters of ``[#*$%&|<>]``;
* dup_lines: lines equal to an earlier line;
* chars: code points in words (word length).

For every (language, source) and signal a quantile sketch is kept: a histogram
whose buckets keep the top ``BITS`` bits of a value (relative error below
2**(1-BITS)).  Sketches of parts of the data merge by adding counts, so they
are built by partial aggregation before the shuffle, and a source that holds a
third of all rows costs one narrow row per task and bucket.  From a sketch come
the quartiles; the fence is ``FENCE`` spreads outside them, where the spread is
the larger of the quartile distance and a floor per signal.  The floor keeps a
uniform source from rejecting documents that differ by next to nothing.

The counts are made once and written; sketches and verdicts read them.  The
thresholds, one narrow row per (language, source), are written, too, so Spark
knows their size when they join the counted rows: under its broadcast threshold
no counted row and no text moves, beyond it the join shuffles (and Spark may
split a hot group).  A document is kept if no signal is outside its fences and
the base rules, which have no threshold to adapt, pass.

Defined results: a null text has no words and fails the base rules, as an
empty one does; a text of any length is counted whole; null languages or
sources form a group of their own; a document is never compared with others by
id, so repeated rows, null and repeated ids are judged one by one; a value equal
to a fence is inside; an empty table gives an empty table.  Extra columns stay,
whatever their names, but for those named as the added ones, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tributary.llm.common import SPACE_CLASS, SPACES, fresh, quoted, write_out

SCALE = 1000
BITS = 7
FENCE = 3
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# floor of the spread by signal, per SCALE words
FLOORS = {"symbols": 50, "dup_lines": 30, "chars": 700}
UPPER_ONLY = ("symbols", "dup_lines")


def words_of(text: Column) -> Column:
    """Words of a text; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def base_counts(text: Column) -> dict[str, Column]:
    """word_chars, n_symbols and n_dup_lines of a text (long)."""
    text = F.coalesce(text, F.lit(""))
    solid = F.translate(text, SPACES, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    return {
        "word_chars": F.length(solid).cast("long"),
        "n_symbols": (F.octet_length(solid) - F.octet_length(F.translate(solid, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words in ``WINDOW``-word windows found twice or more, of an array of words."""
    starts = lambda w: F.sequence(F.lit(0), F.size(w) - WINDOW)

    def covered(pairs: Column) -> Column:
        same = F.filter(pairs, lambda x, j: F.coalesce(F.get(pairs, j - 1)["w"] == x["w"], F.lit(False))
                        | F.coalesce(F.get(pairs, j + 1)["w"] == x["w"], F.lit(False)))
        return F.aggregate(
            F.sort_array(F.transform(same, lambda x: x["i"])),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
            lambda s, i: F.struct((s["n"] + i + WINDOW - F.greatest(i, s["end"])).cast("long").alias("n"),
                                  (i + WINDOW).alias("end")),
            lambda s: s["n"])

    def count(w: Column) -> Column:
        hashes = F.transform(starts(w), lambda i: F.xxhash64(F.slice(w, i + 1, WINDOW)))
        # only texts that have equal hashes pay for the exact step: windows as texts, sorted, equal neighbours
        placed = F.sort_array(F.transform(
            starts(w), lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("w"), i.alias("i"))))
        twice = _once(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when((F.size(w) >= WINDOW) & twice, _once(placed, covered)).otherwise(F.lit(0).cast("long"))

    return _once(words, count)


def bucket(value: Column) -> Column:
    """The sketch bucket of a whole number: its top ``BITS`` bits, the rest zero."""
    shift = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def signals(counts: dict[str, Column], n_words: Column) -> dict[str, Column]:
    """Whole-number rates per ``SCALE`` words; null where there are no words."""
    of = lambda c: F.floor(c * SCALE / n_words).cast("long")
    rates = {"symbols": counts["n_symbols"], "dup_lines": counts["n_dup_lines"], "chars": counts["word_chars"]}
    return {k: F.when(n_words > 0, of(c)) for k, c in rates.items()}


def sketches(counted: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, signal, bucket, n): the mergeable quantile sketches of all documents with words."""
    rates = signals({k: quoted(k) for k in COUNTS}, quoted("n_words"))
    stacked = counted.where(quoted("n_words") > 0).select(
        quoted(lang_col).alias("lang"), quoted(source_col).alias("source"), F.explode(F.array(*[
            F.struct(F.lit(k).alias("signal"), bucket(v).alias("bucket")) for k, v in rates.items()])).alias("s"))
    return (stacked.groupBy("lang", "source", F.col("s.signal").alias("signal"), F.col("s.bucket").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, <signal>_low, <signal>_high) from the sketches' quartiles."""
    group = W.partitionBy("lang", "source", "signal")
    ranked = sketch.select("*", F.sum("n").over(group).alias("total"),
                           F.sum("n").over(group.orderBy("bucket")
                                           .rowsBetween(W.unboundedPreceding, W.currentRow)).alias("upto"))
    first = lambda quarter: F.min(F.when(F.col("upto") * 4 >= F.col("total") * quarter, F.col("bucket")))
    quart = ranked.groupBy("lang", "source", "signal").agg(first(1).alias("q1"), first(3).alias("q3"))
    floor = F.element_at(F.create_map(*[F.lit(x) for kv in FLOORS.items() for x in kv]), F.col("signal"))
    spread = F.greatest(F.col("q3") - F.col("q1"), floor) * FENCE
    fences = quart.select("lang", "source", "signal", (F.col("q1") - spread).alias("low"),
                          (F.col("q3") + spread).alias("high"))
    pick = lambda k, end: F.max(F.when(F.col("signal") == k, F.col(end))).alias(f"{k}_{end}")
    return fences.groupBy("lang", "source").agg(
        *[pick(k, "high") for k in FLOORS], *[pick(k, "low") for k in FLOORS if k not in UPPER_ONLY])


def counted_rows(df: DataFrame, text_col: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without ``drop`` with ``COUNTS`` added; input columns of those names, base_failed and kept go."""
    stay = [c for c in df.columns if c.lower() not in (*COUNTS, "base_failed", "kept") and c not in drop]
    temp = fresh(df.columns, "__words")
    split = df.withColumn(temp, words_of(quoted(text_col)))
    counts = {"n_words": F.size(quoted(temp)).cast("long"), **base_counts(quoted(text_col)),
              "n_repeat_words": repeat_words(quoted(temp))}
    return split.select(*[quoted(c) for c in stay], *[c.alias(k) for k, c in counts.items()])


def judge(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          keep_text: bool = True) -> DataFrame:
    """``df`` with ``COUNTS``, base_failed and kept added; input columns of those names are replaced.

    ``keep_text=False`` leaves the text out.
    """
    spark = df.sparkSession
    rows = write_out(spark, counted_rows(df, text_col, () if keep_text else (text_col,)), "rule-counts")
    limits = write_out(spark, thresholds(sketches(rows, lang_col, source_col)), "rule-limits")
    # names that no row has, so that every column below is found by its name alone
    named = {c: fresh([*rows.columns, *limits.columns], f"__{c}") for c in limits.columns}
    limits = limits.select(*[F.col(c).alias(t) for c, t in named.items()])
    n = quoted("n_words")
    failed = (n < MIN_WORDS) | (quoted("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT)
    joined = rows.join(limits, quoted(lang_col).eqNullSafe(quoted(named["lang"]))
                       & quoted(source_col).eqNullSafe(quoted(named["source"])), "left")
    outside = F.lit(False)
    for k, rate in signals({k: quoted(k) for k in COUNTS}, n).items():
        outside = outside | F.coalesce(rate > quoted(named[f"{k}_high"]), F.lit(False))
        if k not in UPPER_ONLY:
            outside = outside | F.coalesce(rate < quoted(named[f"{k}_low"]), F.lit(False))
    return joined.select(*[quoted(c) for c in rows.columns], failed.alias("base_failed"),
                         (~F.greatest(failed, outside)).alias("kept"))
