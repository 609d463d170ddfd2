"""Scalar functions as Column builders (T01-T23). All stay in the JVM."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import cache
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6378137.0
HALF_WORLD = 20037508.342789244


@cache
def _folding() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """From the Unicode tables: characters whose compatibility decomposition is one ASCII character, and those with more."""
    one_from, one_to, more = [], [], []
    for code in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), *range(0xFB00, 0xFB07)):
        c = chr(code)
        plain = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one_from.append(c)
            one_to.append(plain)
        elif plain:
            more.append((c, plain))
    return "".join(one_from), "".join(one_to), tuple(more)


def to_ascii(text: Column) -> Column:
    """Accents folded, other characters beyond ASCII dropped."""
    one_from, one_to, more = _folding()
    several = "[" + "".join(c for c, _ in more) + "]"
    expanded = text
    for c, plain in more:
        expanded = F.replace(expanded, F.lit(c), F.lit(plain))
    spelt = F.when(text.rlike(several), expanded).otherwise(text)
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(spelt, one_from, one_to), r"[^\x00-\x7F]", "")).otherwise(text)


_ASCII_BLANK = r"[\x09-\x0D\x1C-\x20]+"


def normalize_name(text: Column) -> Column:
    """ASCII, upper case, single spaces."""
    return F.array_join(F.array_remove(F.split(F.upper(to_ascii(text)), _ASCII_BLANK), ""), " ")


def slug(text: Column) -> Column:
    """ASCII, lower case, without apostrophes, words joined by underscores."""
    plain = F.replace(F.lower(to_ascii(text)), F.lit("'"), F.lit(""))
    return F.replace(F.trim(F.regexp_replace(plain, _ASCII_BLANK, " ")), F.lit(" "), F.lit("_"))


def slug_of(text: str) -> str:
    """T02 on the driver, for names of folders."""
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower().replace("'", "")
    return "_".join(plain.split())


def label_slug(text: Column) -> Column:
    """Lower case, letters of any script kept, other signs dropped, 120 characters; null counts as empty."""
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    kept = F.regexp_replace(low, r"(?U)[^\w\s-]+", "")
    return F.substring(F.regexp_replace(F.regexp_replace(kept, r"(?U)[\s-]+", "_"), r"^_+|_+$", ""), 1, 120)


# The suffixes of an address that name a unit or a storage room.
UNIT_SUFFIX, STORAGE_SUFFIX = r"\s+[A-E]?DP\s+\d+\w*.*$", r"\s+B[XD]\s+\d+.*$"


def normalize_address(text: Column) -> Column:
    """Upper case without unit and storage suffixes, single spaces; empty is null."""
    upper = F.trim(F.upper(text))
    cut = F.regexp_replace(F.regexp_replace(upper, UNIT_SUFFIX, ""), STORAGE_SUFFIX, "")
    return F.when(F.length(text) > 0, F.trim(F.regexp_replace(cut, r"\s+", " ")))


def key(text: Column) -> Column:
    """Without a trailing ``.0`` and leading zeros; nothing left is ``0``; null stays null."""
    stripped = F.ltrim(F.regexp_replace(text, r"\.0$", ""), F.lit("0"))
    return F.when(text.isNotNull(), F.when(stripped == "", F.lit("0")).otherwise(stripped))


def role(block: Column, lot: Column, given: Column | None = None) -> Column:
    """``block-lot``, unless a role is given and not empty."""
    made = F.concat(block, F.lit("-"), lot)
    return made if given is None else F.when(F.length(given) > 0, given).otherwise(made)


def expected_period(period: Column) -> Column:
    """``2026S2`` as the label that responses carry; anything else is null."""
    year, half = (F.regexp_extract(F.upper(period), r"^(\d{4})S([12])$", i) for i in (1, 2))
    name = F.when(half == "1", F.lit("PRIMER")).when(half == "2", F.lit("SEGUNDO"))
    return F.concat(name, F.lit(" SEMESTRE DE "), year)


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * EARTH_RADIUS


def mercator_y(lat: Column) -> Column:
    """Null at the poles, where the projection has no value."""
    return F.when(F.abs(lat) < 90, F.ln(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / 2)) * EARTH_RADIUS)


def longitude(x: Column) -> Column:
    return F.degrees(x / EARTH_RADIUS)


def latitude(y: Column) -> Column:
    return F.degrees(F.atan(F.exp(y / EARTH_RADIUS)) * 2 - 1.5707963267948966)


def tile_size(zoom: int) -> float:
    """Side of a tile in projected metres."""
    return 2 * HALF_WORLD / 2**zoom


def supercell_bounds(sc_x: Column, sc_y: Column, zoom: int, tiles: int) -> Column:
    """struct(left, bottom, right, top) of a supercell."""
    size = tile_size(zoom)
    left, top = sc_x * F.lit(size) - HALF_WORLD, F.lit(HALF_WORLD) - sc_y * F.lit(size)
    return F.struct(left.alias("left"), (top - tiles * size).alias("bottom"), (left + tiles * size).alias("right"), top.alias("top"))


def supercell_of(x: Column, y: Column, zoom: int, tiles: int) -> Column:
    """struct(sc_x, sc_y) of the supercell that holds a projected point, in tile units."""
    step = tile_size(zoom) * tiles
    return F.struct((F.floor((x + HALF_WORLD) / step) * tiles).cast("int").alias("sc_x"), (F.floor((F.lit(HALF_WORLD) - y) / step) * tiles).cast("int").alias("sc_y"))


def expanded_bounds(minx: Column, miny: Column, maxx: Column, maxy: Column, cx: Column, cy: Column, least: float = 0.002) -> Column:
    """A window around the centre, twice the extent or twice ``least``."""
    w, h = F.greatest(maxx - minx, F.lit(least)), F.greatest(maxy - miny, F.lit(least))
    return F.struct((cx - w).alias("min_lon"), (cy - h).alias("min_lat"), (cx + w).alias("max_lon"), (cy + h).alias("max_lat"))


def valid_coordinate(lat: Column, lon: Column) -> Column:
    """Both are numbers within range; text that is no number is invalid."""
    number = lambda c: c.try_cast("double")
    return F.coalesce(number(lat).between(-90, 90) & number(lon).between(-180, 180) & ~F.isnan(number(lat)) & ~F.isnan(number(lon)), F.lit(False))


def _halves(value: Column) -> tuple[Column, Column]:
    """A double as the sum of two with half the digits each."""
    big = value * F.lit(134217729.0)  # 2**27 + 1
    high = big - (big - value)
    return high, value - high


def round_half_even(value: Column, places: int) -> Column:
    """To the nearer decimal of so many places by the number's exact value, ties to the even one.

    Whether the number lies beyond the middle is told by the product of number and power of ten with its rounding error.
    """
    scale, twice = F.lit(10.0**places), F.lit(2 * 10.0**places)
    least = F.floor(value * scale)
    product = value * twice
    (a, b), (c, d) = _halves(value), _halves(twice)
    error = ((a * c - product) + a * d + b * c) + b * d
    beyond = (product - (least * 2 + 1)) + error
    low, high = least / scale, (least + 1) / scale
    return F.when(beyond < 0, low).when(beyond > 0, high).when(least % 2 == 0, low).otherwise(high)


def coordinate_key(value: Column) -> Column:
    """Micro-degrees as an integer, ties to the even one."""
    return F.rint(round_half_even(value, 6) * 1_000_000).cast("long")


def utc_now() -> Column:
    """The time in UTC, in ISO form with its offset; the same in all rows of a query."""
    return F.concat(F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def short_hash(value: Column, length: int = 16) -> Column:
    """The first hex digits of SHA-256."""
    return F.substring(F.sha2(value.cast("binary"), 256), 1, length)


def error_text(value: Column) -> Column:
    """T21."""
    return F.substring(value, 1, 500)


def identity(payload: Any) -> str:
    """SHA-256 of canonical JSON, for stage identities on the driver."""
    return hashlib.sha256(json.dumps(payload, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()


def request_identity(code: Column, layer: Column, period: str, zoom: int, tiles: int, sc_x: Column, sc_y: Column) -> Column:
    """What a tile request asks for, hashed; keys in order."""
    return F.sha2(F.to_json(F.struct(code.alias("commune_code"), layer.alias("layer"), F.lit(period).alias("period"), sc_x.alias("sc_x"), sc_y.alias("sc_y"), F.lit(tiles).alias("supercell_tiles"), F.lit(zoom).alias("zoom"))).cast("binary"), 256)
