"""Quality rules with adaptive thresholds from mergeable quantile sketches (native).

Each metric is a non-negative integer. Its sketch counts values in log-linear buckets (exact below 256, then 128 buckets
to each power of two, so a quantile is off by 1 % at most); sketches of any two sets of documents merge by adding
counts, so partial aggregation does most of the work and a hot source costs one row per bucket and task. Thresholds are
upper fences by language and source, ``q75 + SPREAD * (q75 - q25)``, and nothing else: there is no fixed limit below or
above. Before its quantiles are read, a group's sketch is merged with its language's and with that of all documents,
each scaled to ``PRIOR`` documents; so the fences of a small group lean on the others, and those of a large one on itself,
with no size at which one gives way to the other.

The thresholds have one row per language and source. They are broadcast while those are few, else joined under a salt, as
one source may hold a third of the documents; the texts themselves are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwright.llm.text import let, words
from parcelwright.plans.staging import stage

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = r"[#*$%&|<>]"
MARKS = r"[!-/:-@\[-`{-~]"
#: Characters that are ASCII punctuation or symbols, of 1000 in words; hundredths of a character by word; lines equal to
#: an earlier one, of 100, where there are any.
METRICS = ("marks_per_1000", "word_hundredths", "dup_lines_percent")
SPREAD = 5
#: Documents for which a language's sketch counts in those of its sources, and so does that of all documents.
PRIOR = 25
_SCALE = 1_000_000
_BITS = 8
#: Groups whose thresholds are sent to every executor; above, they are joined by a shuffle.
BROADCAST_ROWS = 100_000


def n_repeat_words(w: Column) -> Column:
    """Words covered by the five-word windows that occur twice or more in ``w``, the first occurrence included."""
    windows = F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        by_hash = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s, j, k: F.coalesce(F.get(s, j + k)["h"] == F.get(s, j)["h"], F.lit(False))
        at = let(by_hash, lambda s: F.array_sort(F.transform(F.filter(F.transform(s, lambda x, j: F.when(same(s, j, -1) | same(s, j, 1), x["i"])), lambda i: i.isNotNull()), lambda i: i)))
        return let(at, lambda p: F.aggregate(F.transform(p, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - i, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x))

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))


def features(text: Column) -> Column:
    """struct of the base counts of a whole text; null counts as the empty text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
            n_repeat_words(w).alias("n_repeat_words"),
        )

    return let(
        F.struct(let(words(text), counts).alias("w"), let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("l")),
        lambda s: F.struct(
            s["w"]["n_words"].alias("n_words"), s["w"]["word_chars"].alias("word_chars"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.regexp_count(text, F.lit(MARKS)).cast("long").alias("n_marks"),
            (s["l"]["n"] - s["l"]["d"]).cast("long").alias("n_dup_lines"), s["w"]["n_repeat_words"].alias("n_repeat_words"), s["l"]["n"].cast("long").alias("n_lines"),
        ),
    )


def bucket(value: Column) -> Column:
    """The log-linear bucket of a non-negative integer."""
    exact, half = 1 << _BITS, 1 << _BITS - 1
    e = F.greatest(F.lit(0), F.length(F.bin(value)) - _BITS)
    return F.when(value < exact, value).otherwise(F.lit(exact) + (e - 1) * half + (value / F.pow(F.lit(2.0), e)).cast("long") - half).cast("long")


def lower_bound(b: Column) -> Column:
    """The least value in a bucket."""
    exact, half = 1 << _BITS, 1 << _BITS - 1
    e = ((b - exact) / half).cast("long") + 1
    return F.when(b < exact, b).otherwise((((b - exact) % half + half) * F.pow(F.lit(2.0), e)).cast("long")).cast("long")


def sketches(scored: DataFrame) -> DataFrame:
    """Counts by ``lang, source, metric, bucket`` of the documents that passed the base rules."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), bucket(F.col(m)).alias("bucket")) for m in METRICS])
    each = scored.where(~F.col("base_failed")).select("lang", "source", F.explode(cells).alias("c")).where("c.bucket is not null")
    return each.groupBy("lang", "source", "c.metric", "c.bucket").agg(F.count("*").alias("n"))


def _prior(sketch: DataFrame, by: list[str]) -> DataFrame:
    """The sketch of all groups with the same ``by``, scaled to ``PRIOR`` documents."""
    merged = sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by, "metric"))
    return merged.select(*by, "metric", "bucket", F.col("n"), total.alias("total")).select(*by, "metric", "bucket", F.expr(f"n * {PRIOR * _SCALE}L div total").alias("n"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per ``lang, source``: ``max_<metric>``, null where no document has a value."""
    sketch = stage(sketch, "quality-sketch")
    groups = sketch.select("lang", "source").distinct()
    cells = groups.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in METRICS])))
    by_lang, overall = _prior(sketch, ["lang"]).withColumnsRenamed({"lang": "_lang", "metric": "_metric"}), _prior(sketch, []).withColumnsRenamed({"metric": "_metric"})
    columns = ["lang", "source", "metric", "bucket", "n"]
    merged = sketch.select("lang", "source", "metric", "bucket", (F.col("n") * _SCALE).alias("n"))
    merged = merged.union(cells.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("metric") == F.col("_metric"))).select(*columns))
    # the sketch of all documents has a row per metric and bucket, some thousands at most
    merged = merged.union(cells.join(F.broadcast(overall), F.col("metric") == F.col("_metric")).select(*columns))
    merged = merged.groupBy("lang", "source", "metric", "bucket").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("lang", "source", "metric")
    merged = merged.withColumn("upto", F.sum("n").over(own.orderBy("bucket"))).withColumn("total", F.sum("n").over(own))
    quartile = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, lower_bound(F.col("bucket"))))
    q = merged.groupBy("lang", "source", "metric").agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
    fence = F.col("q3") + SPREAD * (F.col("q3") - F.col("q1"))
    return q.groupBy("lang", "source").agg(*[F.max(F.when(F.col("metric") == m, fence)).alias(f"max_{m}") for m in METRICS])


def _scored(docs: DataFrame, carried: list[Column]) -> DataFrame:
    """The counts and metrics of every row, with ``carried``, written once."""
    f = F.col("f")
    share = lambda a, b, k: F.when(b > 0, F.floor(a * k / b)).otherwise(0).cast("long")
    counts = docs.select(*carried, "lang", "source", features(F.col("text")).alias("f"))
    return stage(counts.select(
        *[c for c in counts.columns if c != "f"], "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines", "f.n_repeat_words",
        ((f["n_words"] < MIN_WORDS) | (f["n_repeat_words"] * 100 > f["n_words"] * MAX_REPEAT_PERCENT)).alias("base_failed"),
        share(f["n_marks"], f["word_chars"], 1000).alias("marks_per_1000"), share(f["word_chars"], f["n_words"], 100).alias("word_hundredths"),
        F.when(f["n_dup_lines"] > 0, share(f["n_dup_lines"], f["n_lines"], 100)).alias("dup_lines_percent"),
    ), "quality-scored")


def _judged(scored: DataFrame, salts: int) -> DataFrame:
    """``scored`` with its group's thresholds and ``kept``."""
    limits = stage(thresholds(sketches(scored)).withColumnsRenamed({"lang": "t_lang", "source": "t_source"}), "quality-fences")
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    if limits.count() <= BROADCAST_ROWS:
        joined = scored.join(F.broadcast(limits), same, "left")
    else:
        limits = limits.withColumn("t_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = scored.join(limits, same & (F.pmod(F.xxhash64("n_words", "word_chars", "n_symbols"), F.lit(salts)).cast("int") == F.col("t_salt")), "left")
    outlier = F.lit(False)
    for m in METRICS:
        outlier = outlier | F.coalesce(F.col(m) > F.col(f"max_{m}"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~outlier)


def judge(docs: DataFrame, salts: int = 16) -> DataFrame:
    """Counts and verdict for every row of ``docs``: doc_id, lang, source, the base counts, base_failed, kept and its
    group's thresholds.

    Null language and null source are groups of their own; an empty text fails the base rule; repeated rows are judged
    alike; a text of any length is counted whole; an empty table gives an empty result; other columns are not read.
    """
    judged = _judged(_scored(docs, [F.col("doc_id")]), salts)
    return judged.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *[f"max_{m}" for m in METRICS])


def keep_good(docs: DataFrame, salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that are kept, all their columns; they travel in the staged table of their counts."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return _judged(_scored(docs, [row]), salts).where("kept").select("row.*")
