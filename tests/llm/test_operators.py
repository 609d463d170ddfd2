"""The operators against brute force, round trips and odd inputs: nulls, empty and long texts, repeated rows, empty tables, extra columns."""

import collections
import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from parcelwright.llm import bpe, chat, fingerprints, langid, licenses, linededup, mixing, neardup, quality, wrappers
from parcelwright.llm.queries import QUERIES
from tests.test_queries import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, _id string"


def odd_docs(spark):
    """Nulls everywhere, empty and blank texts, a long one, repeated rows, clashing columns."""
    long = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
    rows = [
        (1, "a b c d e f g h i j k\nsecond line here", "en", "s1"), (2, None, "en", None), (3, "", None, "s1"), (4, " \t\n\n ", "fr", "s2"), (5, long, "en", "s1"), (6, "a b c d e f g h i j k\nsecond line here", "en", "s1"),
        (6, "a b c d e f g h i j k\nsecond line here", "en", "s1"), (6, "another text with the same id, which has more than ten words in it", None, None), (None, "no id but words enough to be judged by the rules here", "en", "s1"), (7, "éà ß 日本語 \U0001f600 Licensed under CC-BY-NC 4.0", "de", "s2"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), i, "clash") for i, r in enumerate(rows)], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


OPERATORS = {
    "fingerprints": fingerprints.fingerprint_edits, "quality": quality.judge, "keep_good": quality.keep_good, "mix": mixing.mix, "take": mixing.take, "licenses": licenses.scan, "lines": linededup.dedup_lines,
    "near": neardup.near_duplicates, "keep_one": neardup.keep_one, "languages": langid.identify, "bpe": lambda d: bpe.encode_documents(d, bpe.tokenizer_file()),
}
ROW_FOR_ROW = ("fingerprints", "quality", "mix", "licenses", "lines", "near", "languages", "bpe")


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_inputs(spark, name):
    odd = odd_docs(spark)
    got = OPERATORS[name](odd).collect()
    if name in ROW_FOR_ROW:
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert OPERATORS[name](empty_docs(spark)).count() == 0


@pytest.mark.parametrize("name", ["op2_line_dedup", "op4_chat_formatting", "op5_quality_rules", "op7_mixing"])
def test_against_duckdb(spark, data, name):
    from parcelwright.llm.oracles import ORACLES

    compare(spark, data, QUERIES[name], ORACLES[name])


def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def test_fingerprint_edits(spark, data):
    got = sorted(fingerprints.fingerprint_edits(documents(spark, data)).collect(), key=lambda r: r["doc_id"])
    texts = [r["text"] for r in documents(spark, data).orderBy("doc_id").collect()]
    for i, (r, text) in enumerate(zip(got, texts, strict=True)):
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[(i + 1) % len(texts)][:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
    assert len({r["fingerprint"] for r in got}) == len(set(texts))
    assert sum(r["near_edited"] for r in got) / len(got) > 0.4 > 0.15 > sum(r["near_next"] for r in got) / len(got)
    single = fingerprints.fingerprint_edits(documents(spark, data).limit(1)).first()
    assert single["near_next"] == 1.0


def test_fingerprints_are_homomorphic(spark):
    df = spark.createDataFrame([("one\ntwo words\nthree", "two words\nthree\none", "one\nthree", "two words", "one\ntwo words\nthre")], "a string, b string, c string, d string, e string")
    fp = {c: fingerprints.fingerprint(F.col(c)) for c in "abcde"}
    text = fingerprints.to_text
    r = df.select(*[text(fp[c]).alias(f"fp_{c}") for c in "abcde"], text(fingerprints.insert(fp["c"], fp["d"])).alias("sum"), text(fingerprints.delete(fp["a"], fp["d"])).alias("less"), fingerprints.likeness(fp["a"], fp["b"]).alias("same")).first()
    assert r["fp_a"] == r["fp_b"] == r["sum"] != r["fp_e"] and r["less"] == r["fp_c"] and r["same"] == 1.0


def repeat_words(words):
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return len({j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)})


def test_quality_counts(spark):
    rng = random.Random(7)
    texts = ["\n".join(" ".join(rng.choices("ab", k=rng.randrange(9))) for _ in range(rng.randrange(6))) for _ in range(120)] + ["# a *b $x %y &z |q <r> \x0b\x1c t\n# a *b\n\x1c\n # a *b"]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in quality.judge(df).collect():
        t = texts[r["doc_id"]]
        words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeat_words(words))
        assert r["base_failed"] == (len(words) < 10 or 100 * repeat_words(words) > 20 * len(words)) and not (r["kept"] and r["base_failed"])


def test_quantile_sketch_bounds_and_merge(spark):
    values = spark.range(0, 200_000, 7)
    r = values.select(F.max(F.when(fingerprint_of(F.col("id")) > F.col("id"), 1).otherwise(0)).alias("above"), F.max((F.col("id") - fingerprint_of(F.col("id"))) / (F.col("id") + 1)).alias("gap")).first()
    assert r["above"] == 0 and r["gap"] < 1 / 32 + 1e-6


def fingerprint_of(c):
    return quality.lower_bound(quality.bucket(c))


def test_quality_keeps_good_labels(spark, data):
    judged = quality.judge(documents(spark, data)).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").where("not base_failed")
    shares = {r["quality"]: r["share"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares[1] > 0.97 and shares.get(0, 0) < 0.3


def test_mixing_targets_by_rounds(spark):
    sizes = {"a": 100, "b": 5, "c": 1000, "é": 40, None: 10, "z": 0}
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    names = sorted((k for k in sizes if k is not None)) + [None]
    weight = {k: (1, 2, 3)[i % 3] for i, k in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while True:
        total = sum(weight[k] for k in free)
        over = [k for k in free if left * weight[k] / total > 3 * sizes[k]]
        if not over:
            break
        for k in over:
            target[k] = 3 * sizes[k]
            free.discard(k)
        left = sum(sizes.values()) - sum(target.values())
    target |= {k: left * weight[k] / sum(weight[x] for x in free) for k in free}
    assert got == pytest.approx(target)


def test_mixing_takes_what_it_says(spark, data):
    docs = documents(spark, data)
    plan = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    by = collections.defaultdict(list)
    for r in plan:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by[r["source"]].append(r)
    for rows in by.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= max(r["size"] for r in rows)
    assert mixing.take(docs).count() == sum(r["epochs"] for r in plan)


def normalised(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_license_rules(spark, data):
    extra = [
        "SPDX-License-Identifier: GPL-3.0-or-later", "Released under the MIT License. under the mit license", "cc by nc, cc-by-nc\nCC BY NC nd 4.0", "GNU Lesser General Public License version 2.1", "écc by nc under\nthe\tMIT/license", None, "", "İ K under the mit license",
        "This program: you can redistribute it and/or modify it under the terms of the GNU General Public License", "Copyright (c) 2020 Some Body. All rights reserved.", "under the MIT license " * 300,
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License", "released under mit and GPLv3, see the file LICENSE.txt for details",
        "Copyright 2001 A. All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted", "x" * 5 + " the software is provided as is without warranty of any kind express or implied",
        "this work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "SPDX-License-Identifier: CC-BY-NC-SA-4.0 or wtfpl; Beer-Ware License", "Unter dem Titel mit der Lizenz dl-de: Datenlizenz Deutschland Namensnennung 2.0",
    ]
    docs = documents(spark, data).select("doc_id", "text").union(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    compiled = [(r, re.compile(f"(?<= )(?:{r.regex.replace('{w}', '[^ ]+')})(?= )")) for r in licenses.RULES]
    assert len(compiled) >= 400 and len(licenses.SIGNATURES) >= 200
    for got in licenses.scan(docs).collect():
        words = normalised(texts[got["doc_id"]])
        norm = " " + " ".join(words) + " "
        hits = [(norm[: m.start()].count(" ") - 1, norm[: m.start()].count(" ") - 1 + m[0].count(" "), i) for i, (r, c) in enumerate(compiled) for m in c.finditer(norm)]
        kept, reach = [], -1
        for first, last, i in sorted(set(hits), key=lambda h: (h[0], -h[1], h[2])):
            if last > reach:
                kept.append((first, last, i))
                reach = last
        over = lambda a, b: a is not None and b is not None and a[0] <= b[1] and b[0] <= a[1] and a[2] < b[2]
        around = [None, *kept, None]
        kept = [compiled[d[2]][0] for k, d in enumerate(kept) if not over(around[k], d) and not over(around[k + 2], d)]
        base = [(k, label) for phrase, label in licenses.BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        want = (len(words), len(base), min((k for k, _ in base), default=None), max((k for k, _ in base), default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted({x for _, x in base} | {r.label for r in kept})), max((r.weight for r in kept), default=0.0))
        assert tuple(got)[1:8] == want, got["doc_id"]


def test_license_anchors():
    """Every rule has an anchor, a keyword that each of its matches holds, and words enough of its own."""
    for r in licenses.RULES:
        for row in licenses.parts(r.regex):
            assert licenses.anchors(row) and licenses.anchors(row) <= licenses.ANCHORS
    assert licenses.anchors(licenses.parts("(?:a |the )?(?:gpl|lgpl ?3) or (?:later)?")[0]) == {"or"}
    assert licenses.literals(licenses.parts("names? of (?:{w} ){1,8}may x ?y (?:c )?d")[0]) == [" name", " of ", " may x", "y ", " d "]
    assert licenses.keyword_of("(?:proprietary|commercial) (?:license|licence)") == "licen"


def test_license_scan_is_linear(spark):
    import time

    scan = lambda n: licenses.scan(spark.createDataFrame([(1, "so under the MIT license is what it is " * n)], "doc_id long, text string")).select("n_base", F.size("detections").alias("n")).first()
    scan(1)
    begin = time.time()
    assert tuple(scan(100_000)) == (100_000, 100_000)
    assert time.time() - begin < 60


def test_chat_round_trip(spark):
    rng = random.Random(11)
    bits = ["</s>", "[INST]", "[/INST]", "<s>", "\\", "\n", " ", "a", "<<SYS>>", "[ANS]", "[ROLE] x", "é", "[", "<"]
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool\n\\n", "", None]), rng.choice([None, "", "".join(rng.choices(bits, k=8))])) for c in range(40) for t in range(rng.randrange(1, 6))]
    df = spark.createDataFrame(rows + [rows[0]], "conv_id long, turn long, role string, text string")
    segments = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.digest(segments).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows + [rows[0]]:
        by[c].append((t, role is not None, role or "", text is not None, text or ""))
    for c, turns in by.items():
        turns = [(x[2], x[4]) for x in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0


def test_chat_order(spark):
    orders = {1: "system user assistant user", 2: "assistant user", 3: "user user", 4: "user assistant system", 5: "user assistant user assistant"}
    rows = [(c, t, r, "x") for c, o in orders.items() for t, r in enumerate(o.split())]
    got = {r["conv_id"]: r["valid"] for r in chat.digest(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: True}


def test_bpe_equals_the_library(spark, data):
    rng = random.Random(5)
    pool = [chr(c) for a, b in ((9, 14), (32, 0x180), (0x300, 0x330), (0x390, 0x3D0), (0x2000, 0x2070), (0x4E00, 0x4E10), (0x1F600, 0x1F610)) for c in range(a, b)] + ["<|endoftext|>", "'s", " "] * 9
    texts = ["", None, "<|endoftext|><|startoftext|> x <|ENDOFTEXT|>", "ΣΑΣ J̌ İ \x00 a\x1cb", "日本語 é é ŉ ſ", " \n "] + ["".join(rng.choices(pool, k=50)) for _ in range(400)]
    docs = documents(spark, data).select("doc_id", "text").union(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    library = bpe.Vocabulary(bpe.tokenizer_file()).whole
    want = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in bpe.encode_documents(docs, bpe.tokenizer_file(), keep_text=True).collect():
        ids = library.encode(want[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_language_held_out_accuracy(spark, data):
    docs = documents(spark, data)
    got = langid.identify(docs.union(spark.createDataFrame([(90_001, None, "en", "s", 0), (90_002, "123 ½ !!", "en", "s", 5), (90_003, "жщ ъы", None, "s", 5)], docs.schema))).collect()
    by = {r["doc_id"]: r for r in got}
    assert by[90_001]["lang_pred"] == by[90_002]["lang_pred"] == "und" and by[90_003]["lang_pred"] != "und" and by[90_003]["rejected"]
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [by[i]["lang_pred"] == lang for i, lang in truth.items() if by[i]["held_out"]]
    assert sum(held) / len(held) > 0.97
    unlabelled = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [r[0] for r in unlabelled] == ["und"]


def test_kneser_ney_sums_to_one(spark, data):
    model = langid.fit(documents(spark, data).limit(60))
    import numpy as np

    letters = [chr(c) for c in range(32, 0x250)]
    flat = np.array([ord(c) for ch in letters for c in ("t", "h", "e", ch)], np.uint64)
    at = np.arange(3, len(flat), 4)
    total = np.zeros((len(at), len(model.langs)))
    left = np.arange(len(at))
    for order in range(langid.ORDER, 0, -1):
        h = langid._hashes(flat, at[left], order)
        i = np.minimum(np.searchsorted(model.grams[order], h), len(model.grams[order]) - 1)
        hit = model.grams[order][i] == h
        total[left[hit]] += model.logp[order][i[hit]]
        left = left[~hit]
        h = langid._context_hashes(flat, at[left], order)
        i = np.minimum(np.searchsorted(model.contexts[order], h), len(model.contexts[order]) - 1)
        known = model.contexts[order][i] == h
        total[left[known]] += model.backoff[order][i[known]]
    seen = np.ones(len(at), bool)
    seen[left] = False
    sums = np.exp(total[seen]).sum(axis=0)
    assert np.all(sums < 1.001) and np.all(sums > 0.9)


def shingles(text):
    words = WORD.findall(text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_links(texts):
    """Documents linked at Jaccard 0.8 or more, or by equal text, and the smallest id of each component."""
    sets = {i: shingles(t) for i, t in texts.items()}
    links = collections.defaultdict(set)
    for a in sets:
        for b in sets:
            if a < b:
                common = len(sets[a] & sets[b])
                if texts[a] == texts[b] or common and 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                    links[a].add(b)
                    links[b].add(a)
    root = {i: i for i in sets}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in links:
        for b in links[a]:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return links, {i: find(i) for i in sets}


def near_fixture(seed=2):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    for _ in range(30):
        base = [word() for _ in range(rng.randrange(3, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            near = list(base)
            for _ in range(rng.randrange(3)):
                near[rng.randrange(len(near))] = word()
            texts.append((" " if rng.random() < 0.9 else "\n").join(near))
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(90)) for _ in range(25)] + ["", "", "one two", "one  two", "x"]
    return dict(enumerate(texts))


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates_brute_force(spark, monkeypatch, small):
    if small:  # tiny buckets and blocks: every way beyond the usual one is taken
        monkeypatch.setattr(neardup, "BUCKET", 3)
        monkeypatch.setattr(neardup, "BLOCK", 2)
        monkeypatch.setattr(neardup, "BROADCAST_ROWS", 0)
    texts = near_fixture()
    links, component = brute_links(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in neardup.near_duplicates(df).collect()}
    assert {i: r["class_id"] for i, r in got.items()} == component
    assert {i: r["n_links"] for i, r in got.items()} == {i: len(links[i]) for i in texts}
    kept = sorted(r["doc_id"] for r in neardup.keep_one(df).collect())
    assert kept == sorted(set(component.values()))


def test_near_duplicates_of_documents(spark, data):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, data).collect()}
    links, component = brute_links(texts)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(documents(spark, data)).collect()}
    assert {i: (r["class_id"], r["n_links"]) for i, r in got.items()} == {i: (component[i], len(links[i])) for i in texts}


def test_keep_one_of_each_class_whatever_its_id(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(None, text(0)), (None, text(1)), (None, text(1) + " tail"), (None, text(2)), (7, text(3)), (7, text(4)), (7, text(4)), (7, text(5)), (3, text(5) + " tail"), (None, text(3))]
    got = [(r["doc_id"], r["text"].split("x")[0]) for r in neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(None, "w0"), (None, "w1"), (None, "w2"), (7, "w3"), (7, "w4"), (3, "w5")], key=str)


def test_line_templates(spark):
    unique = lambda i: f"document {chr(97 + i)} says something of its own"
    texts = [f"{unique(i)}\nUser {1000 + i} logged in from host {i}.example at noon today\n\nshort line" if i < 12 else unique(i) for i in range(15)]
    texts.append("User 77 logged in from host elsewhere at noon today")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in linededup.dedup_lines(df).collect()}
    assert got[0]["text"] == texts[0] and got[0]["n_dropped"] == 0
    assert got[5]["text"] == f"{unique(5)}\n" and got[5]["n_dropped"] == 2 and got[5]["n_lines"] == 3
    assert got[13]["text"] == texts[13]
    none = {r["doc_id"]: r["n_dropped"] for r in linededup.dedup_lines(df, min_docs=20).collect()}
    assert set(none.values()) == {0}


def test_recurring_templates_are_staged_together(spark, monkeypatch):
    """However many tasks count the templates, the few that recur are one file."""
    rng, staged, real = random.Random(5), {}, linededup.stage
    monkeypatch.setattr(linededup, "stage", lambda df, name: staged.setdefault(name, real(df, name)))
    word = lambda: "".join(rng.choices("abcdefghij", k=8))
    rows = [(i, " ".join(word() for _ in range(20)) + f"\nthe same line {chr(97 + i % 20)} in a hundred documents") for i in range(2000)]
    sizes = dict.fromkeys(("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"), "16k")
    before = {k: spark.conf.get(k) for k in sizes}
    for k, size in sizes.items():
        spark.conf.set(k, size)
    try:
        got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).agg(F.sum("n_dropped")).first()[0]
    finally:
        for k, size in before.items():
            spark.conf.set(k, size)
    assert got == 2000 - 1  # all but the first hold a line that differs from the others' in one word
    assert len(staged["recurring-lines"].inputFiles()) == 1


@pytest.mark.parametrize("n_docs", range(2, 10))
def test_long_lines_in_few_documents(spark, n_docs):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(55))
    near = passage.replace("wordzb", "other")
    texts = [f"own text of {chr(97 + i)}\n{passage}" for i in range(n_docs)] + [f"own text of z\n{near}", "own text of y\na short line"] + ["own text of x\na short line"] * (n_docs - 1)
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(n_docs)] == [texts[0]] + [t.split("\n")[0] for t in texts[1:n_docs]]
    if n_docs < 9:  # else the variant makes ten
        assert [got[i] for i in range(n_docs, len(texts))] == texts[n_docs:]


PAGE = "page_id long, url string, html string, text string"


def test_extraction(spark, data):
    import html

    pages = spark.read.parquet(f"{data}/pages.parquet")
    got = {r["page_id"]: r for r in wrappers.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_extraction_without_article(spark):
    page = lambda i: (
        f'<html><head><title>t</title></head><body class="has-sidebar"><div class="top">Site name</div><!-- c --><div id="c{i}"><h1>Title {i}</h1><p>Body &lt;{i}&gt; <b>bold</b>&nbsp;&amp; more<br>second'
        f'<ul><li>x{i}<li>y{i}</ul></div><div class="post-comments"><p>nice {i}</p></div><div>Subscribe to our letter</div><aside>a{i}</aside><form>f{i}</form><script>if (a < b) document.write("<p>no</p>")</script><footer>{i}</footer></body></html>'
    )
    rows = [(i, f"http://H.com:80/{i}", page(i), "x") for i in range(12)] + [(100, None, None, None), (101, "x", "", None), (102, "http://one.org", "<p>only <i>page</i></p> tail < 3 & <unclosed", None), (None, None, "<article><p>art</p><aside>no</aside></article><p>out", None)]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[3] == "Title 3\nBody <3> bold & more\nsecond\nx3\ny3"
    assert got[100] == got[101] == "" and got[102] == "only page\ntail < 3 & <unclosed" and got[None] == "art"
    assert wrappers.extract(spark.createDataFrame([], PAGE)).count() == 0


def test_template_inside_and_text_outside_articles(spark):
    page = lambda i: (
        f"<body><div>Same on every page</div><article><h1>Teaser {i}</h1><div>Read this on our site</div><p>Body {i}</p>{'<p>more ' * (i % 3)}<p>All rights are with the house</p></article>"
        f"<div><p>Outside {i}</p></div><div class=related><article><p>other {i}</p></article></div></body>"
    )
    rows = [(i, f"http://a.org/{i}", page(i), "") for i in range(12)] + [(20 + i, f"http://copies.org/{i}", "<article><p>one</p></article>", "") for i in range(4)]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert {i: got[i] for i in range(12)} == {i: "\n".join([f"Teaser {i}", f"Body {i}", *["more"] * (i % 3), f"Outside {i}"]) for i in range(12)}
    assert {got[20 + i] for i in range(4)} == {"one"}


def test_wrapper_of_all_pages(spark):
    notices = [f"<div class=n{'abcdefghijklmnopqrstuvwxyz'[k]}>Notice {'abcdefghijklmnopqrstuvwxyz'[k]}</div>" for k in range(25)]  # each on 4 of 100 pages
    rows = [(i, "http://a.org/x", f"<body><h1>Title {i}</h1>{notices[i // 4]}<p>Body {i}</p></body>", "") for i in range(100)]
    pages = spark.createDataFrame(rows, PAGE)
    assert {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()} == {i: f"Title {i}\nBody {i}" for i in range(100)}
    (row,) = wrappers.induce(pages.withColumn("host", F.lit("a.org"))).collect()
    assert all(f"div.n{c}" in row["wrapper"] for c in "abcdefghijklmnopqrstuvwxy")


def test_never_closed():
    import time

    begin = time.time()
    for piece in ('<a title="x>', "<a ", "<!", "</p ", "<div><p>", "<!-- ", "<script>"):
        page = "<article><p>kept</p>" + piece * 20_000
        assert wrappers.main_text(page, wrappers.parse(page)[0].text(), frozenset()).startswith("kept")
    assert time.time() - begin < 60
    assert wrappers.main_text("<article><p title='a > b' data-x=\"<i>\">kept</p><!-- never closed", None, frozenset()) == "kept"


def test_long_tags():
    import time

    data = "data:image/png;base64," + "Ab+/" * 20_000
    many = " ".join(f'data-{i}="{i} > 0"' for i in range(500))
    page = f"<body><nav data-menu='{data}'><p>menu</p></nav><!DOCTYPE {data}><article><p {many}>one</p><img src=\"{data}\"><iframe srcdoc=\"{data}\">no</iframe><p>two</p></article {data}></body>"
    assert wrappers.main_text(page, None, frozenset()) == "one\ntwo"
    begin = time.time()
    for piece in ('<a ">" ', "<a '>' \">\" ", '<a "" ', "<svg/>", "<![CDATA[", "<a <a "):
        for end in ("", "'", '"', ">"):
            wrappers.parse(piece * 50_000 + end)
    assert time.time() - begin < 60


def test_articles_in_named_parts():
    related = '<div class="related"><article><p>other</p></article></div>'
    wide = '<div class="page with-sidebar"><article><header><h1>T</h1></header><p>own</p><div class="share">s</div><footer>f</footer></article></div>'
    assert wrappers.main_text(f"<body><main><p>own</p></main>{related}</body>", None, frozenset()) == "own"
    assert wrappers.main_text(wide, None, frozenset()) == "T\nown"
    assert wrappers.main_text(f"{wide}<section id=comments><article class=comment><p>nice</p></article></section>", None, frozenset()) == "T\nown"


def test_natures_are_of_elements():
    text = lambda page: wrappers.main_text(page, None)
    assert text("<article><p hidden>x</p><p>real</p><p>real2</p></article>") == "real\nreal2"
    assert text('<ul><li aria-hidden="true">x</li><li>real</li></ul>') == "real"
    assert text("<p>a</p><p hidden>secret</p>") == "a"
    assert text('<article><div class="menu-recipe">soup</div><p>p</p></article>') == "soup\np"
    assert text('<article class="comment-policy"><p>be kind</p></article>') == "be kind"
    assert text('<main><p>p</p><div class="site-menu">m</div><div class="cookie-banner-box">c</div><div id="ad-slot-3">a</div></main>') == "p"
    assert text("<article><img src='data:" + "A" * 50_000 + "'><p>short</p></article>") == "short"


@pytest.mark.parametrize("kind", ["mixed", "deep", "distinct"])
def test_long_pages(kind):
    """20,000 blocks: alternating, nested, and each of a class of its own."""
    import time
    import tracemalloc

    letters = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    make = {
        "mixed": lambda n: "".join(f"<h2>h {i}</h2><div>d {i}</div>" for i in range(n // 2)),
        "deep": lambda n: "".join(f"<div>d {i}" for i in range(n)) + "</p></section>" * n,
        "distinct": lambda n: "".join(f"<div class=c{letters(i)}>d {i}</div>" for i in range(n)),
    }[kind]
    page, other = make(20_000), make(19_000)
    begin = time.time()
    wrapper = wrappers.fold(wrappers.parse(other)[0], wrappers.parse(page)[0]).text()
    text = wrappers.main_text(page, wrapper)
    assert time.time() - begin < 10
    assert text.count("\n") == 19_999
    tracemalloc.start()
    wrappers.match_trees(wrappers.Tree.of(wrapper), wrappers.parse(page)[0])
    assert tracemalloc.get_traced_memory()[1] < 200_000_000
    tracemalloc.stop()


def test_wrapper_decides(spark, data):
    """Without its article marks, a page gives nearly the same; the same page on a host where its text is template gives less."""
    pages = spark.read.parquet(f"{data}/pages.parquet")
    bare = pages.withColumn("html", F.regexp_replace("html", "</?article>", ""))
    marked = {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()}
    unmarked = {r["page_id"]: r["text"] for r in wrappers.extract(bare).collect()}
    same = sum(marked[i] == unmarked[i] for i in marked)
    assert same >= 0.95 * len(marked)
    page = lambda i, note: f"<body><article><h1>Title {i}</h1><p>Body {i}</p><p>{note}</p></article></body>"
    rows = [(i, "http://same.org/x", page(i, "One note"), "") for i in range(9)] + [(20 + i, "http://own.org/x", page(i, f"Note {i}"), "") for i in range(8)] + [(30, "http://own.org/x", page(8, "One note"), "")]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[8] == "Title 8\nBody 8" and got[30] == "Title 8\nBody 8\nOne note"


def test_pruned_trees():
    tree = flat(["", [["body", [["div.a", [["p", []]]], ["div.b", []]]]]])
    kept = frozenset(h for h, s in zip(wrappers.paths(tree), tree.sigs, strict=True) if s != "div.a")
    assert wrappers.pruned(tree, kept) == (["", "body", "div.b"], [-1, 0, 1])


def brute_match(a, b):
    """Size of the largest order-preserving alignment of two trees, without memory."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + brute_match(x, y))
    return 1 + m[-1][-1]


def flat(t):
    """Nested lists as a tree in preorder."""
    out = wrappers.Tree([], [])

    def walk(n, parent):
        at = len(out.sigs)
        out.sigs.append(n[0])
        out.parents.append(parent)
        for c in n[1]:
            walk(c, at)

    walk(t, -1)
    return out


def nested(t):
    nodes = [[s, []] for s in t.sigs]
    for i, p in enumerate(t.parents):
        if p >= 0:
            nodes[p][1].append(nodes[i])
    return nodes[0]


def test_tree_matching():
    rng = random.Random(9)

    def tree(depth):
        return [rng.choice("ab"), [tree(depth - 1) for _ in range(rng.randrange(4))] if depth else []]

    for _ in range(60):
        a, b = ["r", [tree(2), tree(2)]], ["r", [tree(2), tree(2)]]
        pairs = wrappers.match_trees(flat(a), flat(b))
        assert len(pairs) == brute_match(a, b) and len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)
        folded = wrappers.fold(flat(a), flat(b))
        assert brute_match(nested(folded), b) == len(flat(b).sigs) and brute_match(nested(folded), a) == len(flat(a).sigs)
        assert len(folded.sigs) == len(flat(a).sigs) + len(flat(b).sigs) - len(pairs)
