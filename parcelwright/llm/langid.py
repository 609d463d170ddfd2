"""Language identification: interpolated Kneser-Ney character models in sorted hash arrays.

One model per language, over characters of lower-cased words (runs of letters) padded with spaces. Every n-gram is a
64-bit hash; for each order the hashes of all languages lie in one sorted array beside a matrix of log probabilities, so
one binary search serves all languages. Languages are compared by cross-entropy per character. Fitting uses a bounded
sample of labelled rows (``max_docs`` per language, the smallest hashes of doc_id); the counting itself runs on the
executors. A fifth of the sample is kept out of the counts to calibrate: the temperature of the score and, per language,
the cross-entropy beyond which a text is flagged as in none of the learned languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwright.plans.staging import stage

ORDER = 4
LETTERS = re.compile(r"[^\W\d_]+")
_MULTIPLIER, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
#: A language's documents are dealt into so many parts, then so many, before the last choice.
SALTS = (64, 8)
#: Chosen documents that are sent to every executor; above, they are joined by a shuffle.
BROADCAST_ROWS = 300_000
#: A worker forgets its scored words beyond so many.
CACHED_WORDS = 300_000
#: Words of a batch whose scores are summed at once.
CHUNK_WORDS = 400_000


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _MULTIPLIER
    return h ^ (h >> np.uint64(32))


def _points(words: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of ``   word `` for each word, one after another, and the position of each word's first letter."""
    padded = [" " * (ORDER - 1) + w + " " for w in words]
    flat = np.frombuffer("".join(padded).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum([len(p) for p in padded])
    return flat, ends


def _predicted(ends: np.ndarray) -> np.ndarray:
    """Positions of the characters that are predicted: all but the leading pads."""
    keep = np.ones(int(ends[-1]) if len(ends) else 0, dtype=bool)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    for k in range(ORDER - 1):
        keep[starts + k] = False
    return np.flatnonzero(keep)


def _hashes(flat: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The hash of the ``order`` characters that end at each position; of order 0, a constant."""
    h = np.full(len(at), np.uint64(order + 1))
    for k in range(order - 1, -1, -1):
        h = _mix(h + flat[at - k] * _MULTIPLIER)
    return h


def _context_hashes(flat: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The hash of the ``order - 1`` characters before each position."""
    return _hashes(flat, at - 1, order - 1)


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def has_letter(words: list[str]) -> bool:
    return any(w.isalpha() for w in words) or any(c.isalpha() for w in words for c in w)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = words_of(text)
            if not words:
                continue
            flat, ends = _points(words)
            at = _predicted(ends)
            for order in range(1, ORDER + 1):
                grams, first, counts = np.unique(_hashes(flat, at, order), return_index=True, return_counts=True)
                where = at[first]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(grams)), "n": pa.array(np.full(len(grams), order, dtype=np.int32)), "gram": pa.array(grams.view(np.int64)),
                    "context": pa.array(_context_hashes(flat, where, order).view(np.int64)), "suffix": pa.array(_hashes(flat, where, order - 1).view(np.int64)), "count": pa.array(counts.astype(np.int64)),
                })


@dataclass
class Model:
    """Per order: sorted n-gram hashes with log probabilities, sorted context hashes with log back-off weights."""

    langs: list[str]
    grams: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    unseen: float
    temperature: float = 1.0
    reject_above: np.ndarray | None = None

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Summed log probabilities by word and language, and the characters that each word predicts."""
        flat, ends = _points(words)
        at = _predicted(ends)
        total = np.zeros((len(at), len(self.langs)), dtype=np.float32)
        left = np.arange(len(at))
        for order in range(ORDER, 0, -1):
            h = _hashes(flat, at[left], order)
            i = np.minimum(np.searchsorted(self.grams[order], h), len(self.grams[order]) - 1)
            hit = self.grams[order][i] == h
            total[left[hit]] += self.logp[order][i[hit]]
            left = left[~hit]
            h = _context_hashes(flat, at[left], order)
            i = np.minimum(np.searchsorted(self.contexts[order], h), len(self.contexts[order]) - 1)
            known = self.contexts[order][i] == h
            total[left[known]] += self.backoff[order][i[known]]
        total[left] += np.float32(self.unseen)
        sizes = np.array([len(w) + 1 for w in words])
        return np.add.reduceat(total, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0), sizes


def _fit(counts: dict[str, np.ndarray], langs: list[str]) -> Model:
    """Interpolated Kneser-Ney from n-gram counts: arrays lang (index), n, gram, context, suffix, count."""
    grams: list[np.ndarray] = [np.zeros(0, np.uint64)]
    logp, contexts, backoff = [np.zeros((0, len(langs)))], [np.zeros(0, np.uint64)], [np.zeros((0, len(langs)))]
    by_order = {n: {k: v[counts["n"] == n] for k, v in counts.items()} for n in range(1, ORDER + 1)}
    alphabet = len(np.unique(by_order[1]["gram"])) + 1
    lower = np.full((1, len(langs)), 1.0 / alphabet)
    lower_keys = None
    for n in range(1, ORDER + 1):
        c = by_order[n]
        keys, first = np.unique(c["gram"], return_index=True)
        row = np.searchsorted(keys, c["gram"])
        seen = np.zeros((len(keys), len(langs)))
        if n == ORDER:
            seen[row, c["lang"]] = c["count"]
        else:  # continuation counts: in how many longer n-grams it is the suffix
            up = by_order[n + 1]
            np.add.at(seen, (np.searchsorted(keys, up["suffix"]), up["lang"]), 1.0)
        context = c["context"][first]
        ctx_keys, ctx_row = np.unique(context, return_inverse=True)
        mass, kinds = np.zeros((len(ctx_keys), len(langs))), np.zeros((len(ctx_keys), len(langs)))
        np.add.at(mass, ctx_row, seen)
        np.add.at(kinds, ctx_row, seen > 0)
        ones, twos = (seen == 1).sum(axis=0), (seen == 2).sum(axis=0)
        discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
        weight = np.where(mass > 0, discount * kinds / np.maximum(mass, 1), 1.0)
        below = lower[np.zeros(len(keys), int)] if lower_keys is None else lower[np.searchsorted(lower_keys, c["suffix"][first])]
        p = np.maximum(seen - discount, 0) / np.maximum(mass, 1)[ctx_row] + weight[ctx_row] * below
        grams.append(keys)
        logp.append(np.log(p).astype(np.float32))
        contexts.append(ctx_keys)
        backoff.append(np.log(weight).astype(np.float32))
        lower, lower_keys = p, keys
    return Model(langs, grams, logp, contexts, backoff, float(np.log(1.0 / alphabet)))


def _scorer(model) -> object:
    """A mapInArrow function: doc_id, text -> doc_id, n_letters, words found, mean cross-entropies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        known: dict[str, int] = {}
        vectors, sizes = np.zeros((0, len(m.langs)), np.float32), np.zeros(0, np.int64)
        for batch in batches:
            docs = batch.column("text").to_pylist()
            start = 0
            while start < len(docs):
                taken: list[list[str]] = []
                n = 0
                while start < len(docs) and (not taken or n < CHUNK_WORDS):
                    taken.append(words_of(docs[start]))
                    n += len(taken[-1])
                    start += 1
                if len(known) > CACHED_WORDS:
                    known, vectors, sizes = {}, vectors[:0], sizes[:0]
                new = [w for w in dict.fromkeys(w for words in taken for w in words) if w not in known]
                if new:
                    known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                    v, s = m.word_scores(new)
                    vectors, sizes = np.concatenate([vectors, v]), np.concatenate([sizes, s])
                entropy = np.full((len(taken), len(m.langs)), np.nan)
                chars = np.zeros(len(taken), np.int64)
                for i, words in enumerate(taken):
                    if words and has_letter(words):
                        at = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
                        chars[i] = sizes[at].sum()
                        entropy[i] = -vectors[at].sum(axis=0, dtype=np.float64) / chars[i]
                yield _verdict(m, batch.column("doc_id").slice(start - len(taken), len(taken)), entropy, chars)

    return run


def _verdict(m: Model, ids: pa.Array, entropy: np.ndarray, chars: np.ndarray) -> pa.RecordBatch:
    some = chars > 0
    best = np.zeros(len(chars), int)
    score, rejected, least = np.zeros(len(chars)), np.zeros(len(chars), bool), np.full(len(chars), np.nan)
    if some.any():
        e = entropy[some]
        best[some] = e.argmin(axis=1)
        least[some] = e.min(axis=1)
        z = -(e - e.min(axis=1, keepdims=True)) * np.sqrt(chars[some])[:, None] / m.temperature
        score[some] = 1.0 / np.exp(z).sum(axis=1)
        if m.reject_above is not None:
            rejected[some] = least[some] > m.reject_above[best[some]]
    named = np.array(m.langs, dtype=object)[best] if m.langs else np.full(len(chars), "und", object)
    return pa.RecordBatch.from_pydict({
        "doc_id": ids.cast(pa.int64()), "lang_pred": pa.array([n if s else "und" for n, s in zip(named, some, strict=True)], pa.string()), "score": pa.array(score),
        "cross_entropy": pa.array(least, mask=~some), "rejected": pa.array(rejected), "entropies": pa.array(list(entropy), pa.list_(pa.float64())), "n_letters": pa.array(chars),
    })


_SCHEMA = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean, entropies array<double>, n_letters long"


def fit(labelled: DataFrame, max_docs: int = 400, reject_quantile: float = 0.999) -> Model:
    """A model from rows ``doc_id, lang, text`` with a known language; at most ``max_docs`` documents by language are used.

    Repeated rows of a document count once (of several texts under one id, the one with the smallest hash). The driver
    gets the n-gram counts of the sample, so what it holds is bounded by ``max_docs`` whole texts for each language.
    Without a labelled row the model has no language, and every prediction is ``und``.
    """
    spark = labelled.sparkSession
    known = labelled.where("lang is not null and text is not null")
    # one row for each document, whatever the number of its rows; partial aggregation takes the copies together
    chosen = known.groupBy("lang", "doc_id").agg(F.min(F.xxhash64("text")).alias("hash")).withColumn("key", F.md5(F.col("doc_id").cast("string")))
    # the smallest hashes of each part first, so that no task sees more than SALTS[-1] * max_docs rows of a language at the end
    for parts in (*SALTS, 1):
        dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("doc_id"), F.lit(parts))).orderBy("key", "doc_id")
        chosen = chosen.withColumn("rank", F.row_number().over(dealt)).where(F.col("rank") <= max_docs)
    chosen = stage(chosen.select(F.col("lang").alias("_lang"), F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "rank"), "langid-chosen")
    side = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    same = (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")) & (F.xxhash64("text") == F.col("_hash"))
    texts = known.select("doc_id", "lang", "text").join(side, same).groupBy("doc_id", "lang", "rank").agg(F.min("text").alias("text"))
    texts = stage(texts.select("doc_id", "lang", "text", (F.col("rank") % 5 == 0).alias("held")), "langid-sample")
    counted = texts.where("not held").select("lang", "text").mapInArrow(_count, "lang string, n int, gram long, context long, suffix long, count long")
    c = counted.groupBy("lang", "n", "gram", "context", "suffix").agg(F.sum("count").alias("count")).toPandas()
    langs = sorted(c["lang"].unique())
    if not langs:
        return Model([], [], [], [], [], 0.0)
    arrays = {"lang": c["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(), "n": c["n"].to_numpy(), "count": c["count"].to_numpy(float)} | {k: c[k].to_numpy().view(np.uint64) for k in ("gram", "context", "suffix")}
    model = _fit(arrays, langs)
    held = texts.where("held")
    sent = spark.sparkContext.broadcast(model)
    scored = held.select("doc_id", "text").mapInArrow(_scorer(sent), _SCHEMA).join(held.select("doc_id", "lang").distinct(), "doc_id").where("n_letters > 0").toPandas()
    scored = scored[scored["lang"].isin(langs)]
    if len(scored):
        e, n = np.stack(scored["entropies"].to_numpy()), scored["n_letters"].to_numpy()
        truth = scored["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
        gaps = -(e - e.min(axis=1, keepdims=True)) * np.sqrt(n)[:, None]

        def loss(t: float) -> float:
            z = gaps / t
            return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())

        model.temperature = min((0.1 * 1.25**k for k in range(24)), key=loss)
        everything = np.quantile(e.min(axis=1), reject_quantile)
        own = [e[truth == i, i] for i in range(len(langs))]
        model.reject_above = np.array([np.quantile(o, reject_quantile) * 1.1 if len(o) >= 20 else everything * 1.1 for o in own])
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, cross_entropy, rejected`` for every row of ``docs``, from its whole text alone.

    A null text and one without a letter are ``und`` with score 0. ``score`` is the calibrated probability of the
    language; ``rejected`` marks texts that are unlike every learned language. Repeated rows are predicted alike; a text
    of any length is scored whole, its words in one pass; of equal entropies the first language by name wins; an empty table gives an empty result.
    """
    if not model.langs:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(False).alias("rejected"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_scorer(sent), _SCHEMA).drop("entropies", "n_letters")


def held_out(doc_id: Column) -> Column:
    """True for documents that training must not see."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def identify(docs: DataFrame, max_docs: int = 400) -> DataFrame:
    """Train on the labelled rows that are not held out, then predict every row of ``docs``."""
    model = fit(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), max_docs)
    return predict(docs, model).withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
