"""Document fingerprints (native): a homomorphic multiset hash of paragraphs.

Every paragraph hashes to a wide vector; a document's fingerprint is the sum of its paragraphs' vectors, each component
modulo a power of two. Sums do not depend on order, and a paragraph is inserted or deleted by adding or subtracting its
vector (``insert``, ``delete``). The vector has two parts:

* ``exact``: 8 components modulo 2**60 cut from SHA-512 of the paragraph, for equality.
* ``near``: 128 counters modulo 2**32, two to a long, of the hash bits of the paragraph's segments (runs of a few words
  that end where the text itself says so), for likeness. Bits are read as signs, so the dot product of two documents'
  counters estimates how many segments they share; the estimate is right up to 2**31 segments.

Counting takes eight passes over the segments for 64 counters: a long holds eight counters of a byte, which are widened
after every 127 segments. Texts are compared as multisets of paragraphs: equal texts have equal fingerprints, and so have
two orders of the same paragraphs. Null counts as the empty text, which is one empty paragraph.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwright.llm.text import block, blocks, let

EXACT, EXACT_BITS = 8, 60
_EXACT_MASK = (1 << EXACT_BITS) - 1
LANE_BITS, HASHES = 32, 2
LANES = 64 * HASHES
_LANE_MASK = (1 << LANE_BITS) - 1
_ONES = 0x0101010101010101
CHUNK = 127
SEGMENTS, MAX_RANGES = 1024, 1_000_000
#: A segment ends at white space after one of these characters (about every third word ends in one), or after a stop or
#: a frequent character of scripts that put no white space there.
SEGMENT_END = r"(?<=[.,;:!?|%#&*$dnry。、，！？；])\s+|(?<=[。、，！？；的了是在不有のをはにがとで다는이가])(?=\S)"


def _shifted(x: Column, n: Column | int) -> Column:
    return F.call_function("shiftrightunsigned", x, n if isinstance(n, Column) else F.lit(n))


def fingerprint(text: Column) -> Column:
    """struct(exact array<bigint>, near array<bigint>, n bigint) of a whole text."""
    text = F.coalesce(text, F.lit(""))

    def exact(hashes: Column) -> Column:
        width = EXACT_BITS // 4
        lane = lambda i: F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: (a + F.conv(F.substring(h, width * i + 1, width), 16, 10).cast("long")).bitwiseAND(F.lit(_EXACT_MASK)))
        return F.array(*[lane(i) for i in range(EXACT)])

    def counters(hashes: Column) -> Column:
        bytewise = lambda chunk, i: F.aggregate(chunk, F.lit(0).cast("long"), lambda a, x: a + F.shiftrightunsigned(x, i).bitwiseAND(F.lit(_ONES)))
        sums = F.transform(blocks(hashes, CHUNK), lambda c: let(block(hashes, c, CHUNK), lambda chunk: F.array(*[bytewise(chunk, i) for i in range(8)])))

        def widened(parts: Column) -> Column:
            lane = lambda p: F.aggregate(parts, F.lit(0).cast("long"), lambda a, q: (a + _shifted(F.get(q, (p % 8).cast("int")), (p - p % 8).cast("int")).bitwiseAND(F.lit(255))).bitwiseAND(F.lit(_LANE_MASK)))
            return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda p: lane(p).bitwiseOR(F.shiftleft(lane(p + 32), LANE_BITS)))

        return let(sums, widened)

    def near(segments: Column) -> Column:
        hashed = lambda salt: F.transform(segments, lambda s: F.xxhash64(s, F.lit(salt)))
        sums = [let(hashed(salt), counters) for salt in range(HASHES)]
        return F.struct(F.concat(*sums).alias("lanes"), F.size(segments).cast("long").alias("n"))

    paragraphs = F.split(text, "\n", -1)
    segments = F.flatten(F.transform(paragraphs, lambda p: F.split(p, SEGMENT_END)))
    e = let(F.transform(paragraphs, lambda p: F.sha2(p.cast("binary"), 512)), exact)
    return let(let(segments, near), lambda s: F.struct(e.alias("exact"), s["lanes"].alias("near"), s["n"].alias("n")))


def _combine(a: Column, b: Column, sign: int) -> Column:
    return F.struct(
        F.zip_with(a["exact"], b["exact"], lambda x, y: (x + y * sign).bitwiseAND(F.lit(_EXACT_MASK))).alias("exact"),
        F.zip_with(a["near"], b["near"], lambda x, y: _lanewise(x, y, sign)).alias("near"),
        (a["n"] + b["n"] * sign).alias("n"),
    )


def _halves(x: Column) -> tuple[Column, Column]:
    """The two counters of a long."""
    return x.bitwiseAND(F.lit(_LANE_MASK)), F.shiftrightunsigned(x, LANE_BITS)


def _lanewise(x: Column, y: Column, sign: int) -> Column:
    low, high = ((a + b * sign).bitwiseAND(F.lit(_LANE_MASK)) for a, b in zip(_halves(x), _halves(y), strict=True))
    return low.bitwiseOR(F.shiftleft(high, LANE_BITS))


def insert(a: Column, b: Column) -> Column:
    """The fingerprint of the paragraphs of both; to add a paragraph, add its own fingerprint."""
    return _combine(a, b, 1)


def delete(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the paragraphs of ``b``."""
    return _combine(a, b, -1)


def to_text(fp: Column) -> Column:
    """The fingerprint as lower-case hex: exact part, ``-``, segment count, ``-``, near part."""
    hexes = lambda values, width: F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), width, "0")), "")
    return F.lower(F.concat(hexes(fp["exact"], EXACT_BITS // 4), F.lit("-"), F.hex(fp["n"]), F.lit("-"), hexes(fp["near"], 16)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the share of segments in common, estimated from the two fingerprints; 1 where the exact parts agree."""
    return let(F.struct(a.alias("a"), b.alias("b")), lambda s: _likeness(s["a"], s["b"]))


def _likeness(a: Column, b: Column) -> Column:
    def dot(p: Column, q: Column, p_n: Column, q_n: Column) -> Column:
        signed = lambda lane, n: (lane * 2 - n).cast("double")
        pair = lambda x, y: reduce(lambda s, t: s + t, [signed(u, p_n) * signed(v, q_n) for u, v in zip(_halves(x), _halves(y), strict=True)])
        return F.aggregate(F.zip_with(p, q, pair), F.lit(0.0), lambda s, v: s + v)

    ab, aa, bb = (dot(p["near"], q["near"], p["n"], q["n"]) for p, q in ((a, b), (a, a), (b, b)))
    near = F.when(aa + bb > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ab * 2 / (aa + bb)))).otherwise(0.0)
    return F.when(a["exact"] == b["exact"], 1.0).otherwise(near)


def _rank(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are below a value: first by every k-th bound, then among the k that follow."""
    k = math.isqrt(len(bounds)) + 1
    as_array = lambda b: F.array(*[F.lit(x) for x in b]).cast("array<bigint>")
    coarse = F.size(F.filter(as_array(bounds[k - 1 :: k]), lambda x: x < value)) * k
    return let(coarse, lambda c: c + F.size(F.filter(F.slice(as_array(bounds), c + 1, F.lit(k)), lambda x: x < value)))


#: Where rows without an id are put: before all others.
_NO_ID = -(2**63)


def _ranges(docs: DataFrame) -> Column:
    """The range of a row by ``_id`` and ``_hash``: quantiles cut the ids into SEGMENTS, each cut evenly, four ranges to a
    shuffle partition in all. An id that fills several quantiles is a segment of its own, cut by the hash of the text
    into as many parts more."""
    wanted = min(MAX_RANGES, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n = min(wanted, SEGMENTS)
    found = docs.select(F.min("_id").alias("lo"), F.max("_id").alias("hi"), F.percentile_approx("_id", [i / n for i in range(1, n)] or [0.5], 10000).alias("cuts")).first()
    if found["lo"] is None:
        return F.lit(0).cast("long")
    lo, hi = found["lo"], found["hi"]
    quantiles = sorted(found["cuts"]) if n > 1 else []
    hot = {c: quantiles.count(c) for c in quantiles if quantiles.count(c) > 1}
    cuts = sorted({c for c in [*quantiles, *(h - 1 for h in hot)] if lo <= c < hi})
    lows, highs = [lo, *(c + 1 for c in cuts)], [*cuts, hi]
    parts = [-(-wanted // len(lows)) * (hot.get(low, 1) if low == high else 1) for low, high in zip(lows, highs, strict=True)]
    starts = [sum(parts[:i]) for i in range(len(parts))]
    widths = [max(1, -(-(high - low + 1) // p)) for low, high, p in zip(lows, highs, parts, strict=True)]
    at = lambda values, i: F.get(F.array(*[F.lit(float(v)) for v in values]), i)

    def inside(i: Column) -> Column:
        by_id = F.floor((F.col("_id").cast("double") - at(lows, i)) / at(widths, i))
        by_hash = F.floor((F.col("_hash").cast("double") / 2.0**64 + 0.5) * at(parts, i))
        place = F.when(at([float(low == high) for low, high in zip(lows, highs, strict=True)], i) > 0, by_hash).otherwise(by_id)
        return F.greatest(F.lit(0), F.least(at(parts, i).cast("long") - 1, place)).cast("long") + at(starts, i).cast("long")

    return let(_rank(F.col("_id"), cuts), inside)


def with_next(docs: DataFrame, payload: list[str]) -> DataFrame:
    """Add ``next_<column>`` of the next row by ascending doc_id (ties by the hash of the text), the first following the last.

    Rows are dealt once into ranges of doc_id and hash; the first row of each range is also sent to the range before it,
    so no window spans the table, nor all rows of one id. The driver sees SEGMENTS quantiles; the table of first rows,
    broadcast, has a row per range and at most MAX_RANGES or so. Rows without an id come first.
    """
    keyed = docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), "_hash": F.xxhash64("text")})
    ranges = _ranges(keyed)
    firsts = keyed.select("_id", "_hash", ranges.alias("_range")).groupBy("_range").agg(F.min(F.struct("_id", "_hash")).alias("low"))
    order = Window.orderBy("_range")  # one short row per range
    before = F.lag("_range").over(order)
    firsts = firsts.select(F.col("low._id").alias("_first"), F.col("low._hash").alias("_first_hash"), F.coalesce(before, F.max("_range").over(Window.partitionBy())).alias("_to"), F.when(before.isNull(), 2).otherwise(1).alias("_after"))
    sent = keyed.withColumn("_range", ranges).join(F.broadcast(firsts), (F.col("_id") == F.col("_first")) & (F.col("_hash") == F.col("_first_hash")), "left")
    own = F.struct(F.col("_range").alias("b"), F.lit(0).alias("s"))
    place = F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("_to").alias("b"), F.col("_after").alias("s"))))
    sent = sent.withColumn("_place", F.explode(place)).withColumns({"_b": F.col("_place.b"), "_s": F.col("_place.s")}).drop("_place", "_range", "_first", "_first_hash", "_to", "_after")
    order = Window.partitionBy("_b").orderBy("_s", "_id", "_hash", F.coalesce(F.col("text"), F.lit("")))
    following = sent.withColumns({f"next_{c}": F.lead(c).over(order) for c in payload})
    return following.where("_s = 0").drop("_b", "_s", "_id", "_hash")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness, one row per row of ``docs``.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document. A single document is its own next; repeated rows follow each other; a text of any length is hashed whole;
    an empty table gives an empty result; columns other than doc_id and text are not read.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("fp", fingerprint(F.col("text")))
    pairs = with_next(own, ["text", "fp"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    pairs = pairs.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    pairs = pairs.select("doc_id", "n_chars", "fp", "next_fp", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_fp"))
    return pairs.select(
        "doc_id", "n_chars", "edited_sha256", to_text(F.col("fp")).alias("fingerprint"), to_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
