"""Line dedup by a log-template tree.

A line's tokens lead down a tree of fixed depth: token count, then the leading ``DEPTH`` tokens, of which those with a
digit are variable. Below a leaf, the rest of the line is generalised: besides the line itself, each of ``PARTS`` equal
parts of the rest is replaced by a wildcard in turn (for lines of ``min_tokens`` tokens and more, a parameter of ``dedup_lines``), so lines that differ
in one field meet in one template. A template that recurs in ``min_docs`` documents or more is dropped from all of them
but the first, whose occurrence stays. Whole lines of more than ``STEP`` tokens need fewer documents the longer they are,
``min_docs`` divided by the steps begun and 2 at least: with 10, two documents from 41 tokens on. Generalisations always
need ``min_docs``, as what differs between their lines goes too.

Templates are hashes; counting combines before the shuffle, so a line in a third of all documents is one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwright.llm.text import BLANKS, let, packed
from parcelwright.plans.staging import stage

DEPTH, PARTS, MIN_TOKENS, MIN_DOCS = 3, 4, 8, 10
#: Recurring templates that are sent to every executor; above, they are joined by a shuffle.
BROADCAST_ROWS = 300_000
WILDCARD = "<*>"
#: Tokens of a step of a line's length. A template's lowest bits hold the steps of a whole line, 1 for generalisations.
STEP, MAX_STEPS = 10, 15


def tokens(line: Column) -> Column:
    """The tokens of a line; those with a digit are wildcards."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*", WILDCARD)).otherwise(line)
    return F.array_remove(F.split(masked, BLANKS), "")


def templates(line: Column, min_tokens: int = MIN_TOKENS) -> Column:
    """array<bigint>: the hashes of a line's templates, from the line itself to its generalisations; none for a blank line.

    The lowest bits are no hash, but the steps of the template's length.
    """
    stepped = lambda h, steps: h.bitwiseAND(F.lit(~MAX_STEPS)).bitwiseOR(steps.cast("long"))

    def keys(t: Column) -> Column:
        n = F.size(t)
        rest = n - DEPTH
        cut = lambda i: F.floor(rest * i / PARTS).cast("int")
        exact = stepped(F.xxhash64(n, F.lit(-1), t), F.least(F.ceil(n / STEP), F.lit(MAX_STEPS)))
        general = [stepped(F.xxhash64(n, F.lit(i), F.slice(t, F.lit(1), cut(i) + DEPTH), F.slice(t, cut(i + 1) + DEPTH + 1, n)), F.lit(1)) for i in range(PARTS)]
        return F.when(n == 0, F.array().cast("array<bigint>")).when(n < MIN_TOKENS, F.array(exact)).otherwise(F.array(exact, *general))

    return let(tokens(line), keys)


def recurring(keyed: DataFrame, min_docs: int, by_length: bool = True) -> DataFrame:
    """``template, first_doc`` of the templates in at least ``min_docs`` rows of ``keyed`` (doc_id, keys by line), or in
    fewer where ``by_length`` and the line is long."""
    steps = F.col("template").bitwiseAND(F.lit(MAX_STEPS))
    needed = F.least(F.lit(min_docs), F.greatest(F.lit(2), F.ceil(F.lit(min_docs) / steps))) if by_length else F.lit(min_docs)
    each = keyed.select("doc_id", F.explode(F.array_distinct(F.flatten("keys"))).alias("template"))
    return each.groupBy("template").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where(F.col("n") >= needed).select("template", "first_doc")


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, by_length: bool = True, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text``, and ``n_lines``, ``n_dropped`` (lines with a token).

    All columns are kept (but for older ones of these names); n_chars, where there is one, follows the text. Lines are split at ``\\n``; blank lines stay. Null text stays
    null; without ``by_length``, lines of any length need ``min_docs``; lines of fewer than ``min_tokens`` tokens are not
    generalised, as three leading tokens of four say too little; texts and lines of any length are taken whole; rows with equal doc_id and text are changed alike; an empty table gives an empty result.
    """
    text_hash = F.xxhash64(F.col("text"))
    by_line = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda line: templates(line, min_tokens))
    keyed = stage(docs.select("doc_id", text_hash.alias("_hash"), by_line.alias("keys")), "line-templates")
    # few of many templates recur: together they are files of a sensible size, not one for each task that counted some
    often = stage(recurring(keyed, min_docs, by_length).hint("rebalance"), "recurring-lines")
    side = F.broadcast(often) if often.count() <= BROADCAST_ROWS else often
    lines = keyed.select("doc_id", "_hash", F.posexplode("keys").alias("line", "templates")).select("doc_id", "_hash", "line", F.explode("templates").alias("template"))
    hits = lines.join(side, "template").where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    dropped = hits.groupBy(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h")).agg(F.collect_set("line").alias("_dropped"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("row.text") == F.col("_h"))
    joined = packed(docs).join(dropped, same, "left")
    every = F.split(F.col("row.text"), "\n", -1)
    kept = let(F.col("_dropped"), lambda d: F.array_join(F.filter(every, lambda x, i: ~F.array_contains(d, i)), "\n"))
    n_lines = F.size(F.filter(every, lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    out = joined.select(
        "row", F.when(F.col("_dropped").isNull(), F.col("row.text")).otherwise(kept).alias("_text"),
        F.when(F.col("row.text").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"), F.coalesce(F.array_size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    changed = {"text": F.col("_text"), "n_chars": F.when(F.col("_text").isNotNull(), F.char_length("_text").cast("long")).otherwise(F.col("row.n_chars").cast("long")) if "n_chars" in docs.columns else None}
    columns = [changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*columns, "n_lines", "n_dropped")
