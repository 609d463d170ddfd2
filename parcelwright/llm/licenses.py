"""License scans (native): ordered signature rules over normalised words.

A rule is a regular expression over the text's words (lower-case ASCII, one space between words), with a keyword, a
priority (its place in ``RULES``), a label and a weight. Only texts that hold one of the rules' anchors, words of which
every match has one, are normalised, and only rules whose keyword occurs are run. For that, every word is followed by its number, which the patterns skip, so a match says at which
words it begins and ends, and finding all places takes time linear in the text. Detections are word intervals: one that
lies inside another is suppressed (of equal intervals the rule of higher priority stays), and of two neighbours that
overlap in part the one of higher priority stays. Everything happens inside a row: no shuffle at all.
"""

from __future__ import annotations

import re
from functools import cache
from os.path import commonprefix
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwright.llm.signatures import SIGNATURES
from parcelwright.llm.text import block, blocks, let

#: A word is a run of ASCII letters, digits and anything outside ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What stands between a word and its number.
MARK = "\x02"
#: Detections of a text that are folded at once when intervals are compared.
BLOCK = 256

#: The base phrases with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


class Rule(NamedTuple):
    label: str
    regex: str
    keyword: str
    weight: float


_V = r"(?:v|version |v )?"
#: label, keyword, how texts name it, its words in an SPDX identifier
NAMES = (
    ("mit", "mit", r"(?:the )?mit", r"mit"),
    ("mit-0", "mit", r"mit (?:no attribution|0)", r"mit 0"),
    ("apache-2", "apache", rf"apache (?:software )?(?:license |licence )?{_V}2(?: 0)?", r"apache 2 0"),
    ("apache-1.1", "apache", rf"apache (?:software )?(?:license |licence )?{_V}1 1", r"apache 1 1"),
    ("gpl-3", "general public", rf"(?:gnu )?general public license {_V}3(?: 0)?", r"gpl 3 0(?: only| or later)?"),
    ("gpl-2", "general public", rf"(?:gnu )?general public license {_V}2(?: 0)?", r"gpl 2 0(?: only| or later)?"),
    ("gpl-1", "general public", rf"(?:gnu )?general public license {_V}1(?: 0)?", r"gpl 1 0(?: only| or later)?"),
    ("gpl-3", "gpl", rf"(?:gnu )?(?:gpl {_V}3|gplv3|gpl3)(?: 0)?", r"gplv3"),
    ("gpl-2", "gpl", rf"(?:gnu )?(?:gpl {_V}2|gplv2|gpl2)(?: 0)?", r"gplv2"),
    ("lgpl-3", "lesser", rf"(?:gnu )?lesser general public license {_V}3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lesser", rf"(?:gnu )?lesser general public license {_V}2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-2", "library", rf"(?:gnu )?library general public license {_V}2(?: 0)?", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl-3", "lgpl", rf"(?:gnu )?(?:lgpl {_V}3|lgplv3|lgpl3)(?: 0)?", r"lgplv3"),
    ("agpl-3", "affero", rf"(?:gnu )?affero general public license {_V}3(?: 0)?", r"agpl 3 0(?: only| or later)?"),
    ("agpl-3", "agpl", rf"(?:gnu )?(?:agpl {_V}3|agplv3|agpl3)(?: 0)?", r"agplv3"),
    ("gfdl-1.3", "documentation", rf"(?:gnu )?free documentation license {_V}1 3", r"gfdl 1 3(?: only| or later)?"),
    ("gfdl-1.2", "documentation", rf"(?:gnu )?free documentation license {_V}1 2", r"gfdl 1 2(?: only| or later)?"),
    ("bsd-2", "bsd", r"(?:2 clause|two clause|simplified|freebsd) bsd|bsd (?:2 clause|two clause)", r"bsd 2 clause"),
    ("bsd-3", "bsd", r"(?:3 clause|three clause|new|modified|revised) bsd|bsd (?:3 clause|three clause)", r"bsd 3 clause"),
    ("bsd-4", "bsd", r"(?:4 clause|four clause|original|old) bsd|bsd (?:4 clause|four clause)", r"bsd 4 clause"),
    ("bsd-0", "bsd", r"(?:0|zero) clause bsd|bsd (?:0|zero) clause", r"0bsd"),
    ("mpl-2", "mozilla", rf"mozilla public license {_V}2(?: 0)?", r"mpl 2 0"),
    ("mpl-1.1", "mozilla", rf"mozilla public license {_V}1 1", r"mpl 1 1"),
    ("epl-2", "eclipse", rf"eclipse public license {_V}2(?: 0)?", r"epl 2 0"),
    ("epl-1", "eclipse", rf"eclipse public license {_V}1(?: 0)?", r"epl 1 0"),
    ("cddl-1", "development", rf"common development and distribution license {_V}1(?: 0)?", r"cddl 1 0"),
    ("eupl-1.2", "european", rf"european union public (?:license|licence) {_V}1 2", r"eupl 1 2"),
    ("eupl-1.1", "european", rf"european union public (?:license|licence) {_V}1 1", r"eupl 1 1"),
    ("isc", "isc", r"isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?", r"zlib"),
    ("bsl-1", "boost", rf"boost software license(?: {_V}1(?: 0)?)?", r"bsl 1 0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", rf"wtfpl(?: {_V}2)?", r"wtfpl"),
    ("artistic-2", "artistic", rf"artistic license {_V}2(?: 0)?", r"artistic 2 0"),
    ("artistic-1", "artistic", rf"artistic license {_V}1(?: 0)?", r"artistic 1 0"),
    ("ofl-1.1", "open font", rf"(?:sil )?open font license(?: {_V}1 1)?", r"ofl 1 1"),
    ("postgresql", "postgresql", r"postgresql", r"postgresql"),
    ("psf-2", "python", r"python software foundation", r"psf 2 0"),
    ("odbl-1", "open database", rf"open database license(?: {_V}1(?: 0)?)?", r"odbl 1 0"),
    ("odc-by-1", "open data commons", rf"open data commons attribution license(?: {_V}1(?: 0)?)?", r"odc by 1 0"),
    ("pddl-1", "public domain", rf"public domain dedication and license(?: {_V}1(?: 0)?)?", r"pddl 1 0"),
    ("ms-pl", "microsoft", r"microsoft public", r"ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal", r"ms rl"),
    ("ecl-2", "educational", rf"educational community license(?: {_V}2(?: 0)?)?", r"ecl 2 0"),
    ("afl-3", "academic", rf"academic free license(?: {_V}3(?: 0)?)?", r"afl 3 0"),
    ("osl-3", "open software", rf"open software license(?: {_V}3(?: 0)?)?", r"osl 3 0"),
    ("cpl-1", "common public", rf"common public license(?: {_V}1(?: 0)?)?", r"cpl 1 0"),
    ("lppl-1.3", "latex", rf"latex project public license(?: {_V}1 3c?)?", r"lppl 1 3c"),
    ("upl-1", "universal", rf"universal permissive license(?: {_V}1(?: 0)?)?", r"upl 1 0"),
    ("cecill-2.1", "cecill", rf"cecill(?: {_V}2 1)?", r"cecill 2 1"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", r"ncsa"),
)
#: Creative Commons: label, abbreviation, words of the full name
COMMONS = (
    ("cc-by-nc-nd", "by nc nd", "attribution noncommercial no ?derivatives|attribution non commercial no ?derivatives"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nd", "by nd", "attribution no ?derivatives|attribution no ?derivs"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by", "by", "attribution"),
)
_GRANT = r"(?:(?:is |are )?(?:licensed|released|distributed|published|available|provided|offered|covered)(?: to you)? )?under (?:the )?(?:terms of )?(?:the |an |a )?"


#: What rare words hold: a rule's anchor is one of them if it can be.
TELLING = ("licen", "gpl", "copyright", "warrant", "redistribut", "spdx", "trademark", "disclaim", "permission")
#: Words that many texts hold: anchors only where a rule has no other word.
SHORT = frozenset(("cc", "cc0", "gpl", "bsd", "isc"))
COMMON = frozenset("under new old original general public software provided return conditions products government project received community available business information of only see just kind any for the and with use this that not may by is as shall think called larger used obtain stuff package document contains open derived".split())


class Part(NamedTuple):
    """A piece of a rule's expression: a literal, or the alternatives of a group; ``needed`` if every match has it."""

    text: str
    options: tuple[tuple[Part, ...], ...]
    needed: bool


_TOKEN = re.compile(r"\[[^\]]*\]|\{w\}|\{\d+,\d+\}|\(\?:|[()?|]|[^\[\](){}?|]")


def parts(regex: str) -> tuple[tuple[Part, ...], ...]:
    """The alternatives of an expression, which may use groups, ``|``, ``?``, ``{m,n}``, classes and ``{w}``, each a row of parts."""
    stack: list[list[list[Part]]] = [[[]]]
    for token in _TOKEN.findall(regex):
        row = stack[-1][-1]
        if token in ("(?:", "("):
            stack.append([[]])
        elif token == "|":
            stack[-1].append([])
        elif token == ")":
            options = tuple(map(tuple, stack.pop()))
            stack[-1][-1].append(Part("", options, True))
        elif token == "?" or token[0] == "{" and token[1].isdigit():
            row[-1] = row[-1]._replace(needed=token[:2] == "{1")
        elif token[0] in "[{":
            row.append(Part("\n", (), True))  # any character or word
        else:
            row.append(Part(token, (), True))
    return tuple(map(tuple, stack[0]))


def _edge(row: tuple[Part, ...], last: bool) -> bool:
    """Whether whatever a row matches begins (or ends) with a space, or is empty."""
    for part in reversed(row) if last else row:
        if part.options:
            if not all(_edge(o, last) for o in part.options):
                return False
        elif part.text != " ":
            return False
        if part.needed:
            return True
    return True


def literals(row: tuple[Part, ...]) -> list[str]:
    """The strings that every match of a row of parts holds; whole words are those between spaces."""
    text = [" " if not row or row[0].options == () and row[0].needed else "\n"]
    for k, part in enumerate(row):
        if part.options:
            text.append(("" if _edge(row[:k], True) else "\n") + " \n " if all(_edge(o, False) and _edge(o, True) for o in part.options) else " \n" if all(_edge(o, False) for o in part.options) else "\n " if all(_edge(o, True) for o in part.options) else "\n")
        else:
            text.append(part.text if part.needed else "\n")
    return [x for x in ("".join(text) + " ").split("\n") if x.strip(" ")]


def anchors(row: tuple[Part, ...]) -> frozenset[str]:
    """Words of which every match of a row of parts holds one: a whole word that it needs, or of each of a group's
    alternatives one, whichever is rarer; empty if there are none."""
    found = [frozenset([w]) for text in literals(row) for w in text.split(" ")[1:-1] if w]
    for part in row:
        if part.options and part.needed and all(inside := [anchors(o) for o in part.options]):
            found.append(frozenset().union(*inside))
    cost = lambda words: (max(2 if w in COMMON or len(w) <= 3 and w not in SHORT else 0 if any(t in w for t in TELLING) else 1 for w in words), len(words), -max(map(len, words)))
    return min(found, key=cost, default=frozenset())


def keyword_of(regex: str) -> str:
    """The longest string that every match of a rule holds, be it what a group's alternatives begin with."""
    rows = parts(regex)
    if len(rows) > 1:
        raise ValueError(f"an alternation needs a group: {regex}")
    shared = [commonprefix(["".join(p.text if p.needed and not p.options else "\n" for p in o).split("\n")[0] for o in part.options]) for part in rows[0] if part.options and part.needed]
    return max((x.strip(" ") for x in (*literals(rows[0]), *shared)), key=len)


def _rules() -> tuple[Rule, ...]:
    out = [Rule(label, f"spdx license identifier (?:{spdx})", "spdx license identifier", 1.0) for label, _, _, spdx in NAMES]
    for label, short, _ in COMMONS:
        out.append(Rule(label, f"spdx license identifier cc {short}(?: [1-4] [05])?", "spdx license identifier cc", 1.0))
        out.append(Rule(label, rf"{_GRANT}(?:creative commons |cc ){short}(?: {_V}[1-4] [05])?(?: international| unported)?(?: licen[cs]e)?", "under" if short == "by" else short, 0.97))
        out.append(Rule(label, rf"creativecommons org licenses {short}(?: [1-4] [05])?", "creativecommons org licenses", 0.95))
    for label, _, full in COMMONS:
        out.append(Rule(label, rf"creative commons (?:{full})(?: {_V}[1-4] [05])?(?: international| unported)?(?: licen[cs]e)?", "creative commons", 0.95))
    out += [Rule(label, regex, keyword_of(regex), weight) for label, weight, regex in SIGNATURES if weight >= 0.9]
    # mit is a word of other languages, so there it takes the word license, or what is done under it
    grant = lambda label: "(?: (?:license|licence))" + "?" * (label not in ("mit", "mit-0"))
    out += [Rule(label, rf"{_GRANT}(?:{name}){grant(label)}(?: {_V}[0-9](?: [0-9])?)?(?: or (?:any )?later(?: version)?)?", keyword, 0.95) for label, keyword, name, _ in NAMES]
    out.append(Rule("mit", r"(?:licensed|released|distributed|published) under (?:the )?mit", "under", 0.95))
    out += [Rule(label, rf"(?:opensource org licenses|spdx org licenses) (?:{spdx})", "org licenses", 0.9) for label, _, _, spdx in NAMES]
    out += [Rule(label, rf"(?:{name}) (?:license|licence)", keyword, 0.8) for label, keyword, name, _ in NAMES]
    out += [Rule(label, name, keyword, 0.7) for label, keyword, name, _ in NAMES if "licen" in name or "gpl" in name]
    out += [Rule(label, f"cc {short}(?: {_V}[1-4] [05])?", f"cc {short}", 0.8) for label, short, _ in COMMONS]
    out += [Rule(label, regex, keyword_of(regex), weight) for label, weight, regex in SIGNATURES if weight < 0.9]
    out += [Rule(label, phrase, phrase, 0.8) for phrase, label in BASE]
    return tuple(out)


RULES = _rules()
#: Every match of a rule holds one of these words, so a text without them can match none.
ANCHORS = frozenset().union(*[anchors(row) for r in RULES for row in parts(r.regex)])


def words_of(text: Column) -> Column:
    """The words of a text in lower case (of any script, which the rules don't mind)."""
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def normalise(text: Column) -> Column:
    """`` word word word `` with ASCII letters in lower case."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, SEPARATORS, " ")), F.lit(" "))


def numbered(norm: Column) -> Column:
    """`` word#0 word#1 word#2 `` with the mark for #."""
    words = F.transform(F.split(F.trim(norm), " "), lambda w, i: F.concat(w, F.lit(MARK), i.cast("string")))
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def pattern(regex: str) -> str:
    """A rule's expression over numbered words: whole words only, whose numbers it skips; ``{w}`` is any word."""
    number = MARK + "[0-9]+"
    return f"(?<= )(?:{regex.replace(' ?', f'(?:{number}~)?').replace(' ', number + '~').replace('~', ' ').replace('{w}', f'[^ {MARK}]+')}){number}(?= )"


def _places(text: Column, regex: str) -> Column:
    """array<struct<first, last>>: the word intervals of numbered words that a regex matches, left to right."""

    def place(match: Column) -> Column:
        first, last = F.substring_index(F.substring_index(match, " ", 1), MARK, -1), F.substring_index(match, MARK, -1)
        return F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"))

    return F.transform(F.regexp_extract_all(text, F.lit(pattern(regex)), F.lit(0)), place)


_HIT = "struct<first:int,neg_last:int,rank:int,label:string,weight:double>"


def _suppressed(hits: Column) -> Column:
    """Sorted detections without those that lie inside an earlier one, or overlap a neighbour of higher priority.

    How far earlier detections reach is folded in blocks, so that long arrays are not copied for every element.
    """

    def by_block(a: Column) -> Column:
        part = lambda b: block(a, b, BLOCK)
        reaches = F.transform(blocks(a, BLOCK), lambda b: F.array_max(F.transform(part(b), lambda d: -d["neg_last"])))

        def fold(m: Column, b: Column) -> Column:
            none = F.struct(F.coalesce(F.array_max(F.slice(m, F.lit(1), b)), F.lit(-1)).alias("reach"), F.array().cast(f"array<{_HIT}>").alias("kept"))
            step = lambda acc, d: F.when(-d["neg_last"] <= acc["reach"], acc).otherwise(F.struct((-d["neg_last"]).alias("reach"), F.concat(acc["kept"], F.array(d)).alias("kept")))
            return F.aggregate(part(b), none, step, lambda acc: acc["kept"])

        return let(reaches, lambda m: F.flatten(F.transform(blocks(a, BLOCK), lambda b: fold(m, b))))

    def priority(a: Column) -> Column:
        def stays(d: Column, i: Column) -> Column:
            before, after = F.get(a, i - 1), F.get(a, i + 1)
            yields = lambda other, overlap: F.coalesce(overlap & (other["rank"] < d["rank"]), F.lit(False))
            return ~(yields(before, -before["neg_last"] >= d["first"]) | yields(after, after["first"] <= -d["neg_last"]))

        return F.filter(a, stays)

    return let(let(F.array_sort(hits), by_block), priority)


@cache
def _found() -> str:
    """SQL for the matches of every rule whose keyword occurs in ``x.norm``, over the numbered words ``x.words``.

    As text it is parsed at once; the patterns are literals, so each is compiled once in a task.
    """
    rules = [f"struct({i} AS rank, '{r.label}' AS label, {r.weight}D AS weight, CASE WHEN contains(x.norm, '{r.keyword}') THEN regexp_extract_all(x.words, '{pattern(r.regex)}', 0) END AS found)" for i, r in enumerate(RULES)]
    return f"filter(array({', '.join(rules)}), r -> size(r.found) > 0)"


def _detections(s: str) -> Column:
    """The detections of the rules whose keyword occurs, those left after suppression; ``s`` names a struct<norm, words>."""
    first, last = f"substring_index(substring_index(m, ' ', 1), '{MARK}', -1)", f"substring_index(m, '{MARK}', -1)"
    hit = f"struct(int({first}) AS first, -int({last}) AS neg_last, r.rank AS rank, r.label AS label, r.weight AS weight)"
    return _suppressed(F.expr(f"flatten(transform(transform(array({s}), x -> {_found()})[0], r -> transform(r.found, m -> {hit})))"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its doc_id with word count, base places, detections, labels and score.

    ``detections`` are array<struct<first, neg_last, rank, label, weight>> of word positions, after suppression. The
    score is the largest weight of a detection, 0 without any. Null counts as the empty text; repeated rows are scanned
    alike; a text of any length is scanned whole, in time linear in its words and matches; of rules that match the same
    words the first in ``RULES`` counts; an empty table gives an empty result; columns other than doc_id and text are
    not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    empty = F.array().cast(f"array<{_HIT}>")

    held = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.arrays_overlap(w, F.array(*[F.lit(a) for a in sorted(ANCHORS)])).alias("gate")))
    looked = docs.select("doc_id", text.alias("text"), held.alias("held"))
    normal = let(normalise(F.col("text")), lambda n: F.struct(n.alias("norm"), numbered(n).alias("words")))
    looked = looked.select("doc_id", "held.n_words", F.when(F.col("held.gate"), normal).alias("s"))
    base = F.array(*[F.struct(F.lit(label).alias("label"), _places(F.col("s.words"), phrase).alias("at")) for phrase, label in BASE])
    looked = looked.select("doc_id", "n_words", F.when(F.col("s").isNotNull(), F.struct(base.alias("base"), _detections("s").alias("detections"))).alias("s"))
    starts = F.coalesce(F.flatten(F.transform("s.base", lambda b: F.transform(b["at"], lambda p: p["first"]))), F.array().cast("array<int>"))
    base_labels = F.coalesce(F.transform(F.filter("s.base", lambda b: F.size(b["at"]) > 0), lambda b: b["label"]), F.array().cast("array<string>"))
    looked = looked.select("doc_id", "n_words", starts.alias("starts"), base_labels.alias("base_labels"), F.coalesce("s.detections", empty).alias("detections"))
    found = F.transform("detections", lambda d: d["label"])
    return looked.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"), F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union("base_labels", found)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["weight"])), F.lit(0.0)).alias("score"), "detections",
    )
