"""N-gram Jaccard join by chosen paths.

Sets of five-word shingles are embedded, as in the published chosen-path join (Christiani, Pagh and Sivertsen, 2018), as
sets of ``COORDINATES`` tokens (coordinate, min-hash value), so that sets of any size share tokens in proportion to their
similarity. A run starts by sampling one token of each set: sets that share it share a path. A bucket (the sets of one path) of at most ``BUCKET`` sets is compared by brute
force on the sketches; a larger one is split further, by coordinates sampled from its path, ``BRANCHES`` at a time. Before that, its
sets are compared with its first: those alike are linked to it, and those that agree on ``LEAVE`` coordinates need not go
on, as whatever is linked to them is like the first too; so a large group of near copies shrinks at once.
Runs are repeated so often that a pair at the threshold is missed with probability 1 - ``RECALL`` at most. Buckets that
stay large at ``DEPTH`` agree on so many coordinates that all of their sets are linked to the first as candidates.

Candidate links only select: their connected components are then verified with exact Jaccard over whole shingle sets,
all pairs within a component, in blocks of ``BLOCK`` sets, so a component of any size is compared whole and no task
holds more than two blocks; where only classes are asked for, ``class_links`` spares most pairs of blocks. Equal texts are one set with a number of copies. What leaves a block is one row per set, not
one per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwright.llm.text import packed
from parcelwright.operators.graph import connected_components
from parcelwright.plans.staging import stage

SHINGLE = 5
#: Jaccard threshold as a fraction, so that comparisons are exact.
NUMERATOR, DENOMINATOR = 4, 5
COORDINATES = 64
#: Coordinates that must agree for a candidate; a pair at the threshold agrees on fewer with probability 5e-7.
AGREE = 36
RECALL = 0.99999
LEAVE = 56
BUCKET, BRANCHES, DEPTH = 2000, 2, 5
BLOCK, BLOCK_SHINGLES = 1000, 3_000_000
#: Members of candidate components that are sent to every executor; above, texts and members are joined by a shuffle.
BROADCAST_ROWS = 300_000
_BLANK = " \t\n\v\f\r"
_SEEDS = np.random.default_rng(20240229).integers(1, 2**32, size=(COORDINATES, 1), dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_OFFSETS = np.random.default_rng(20240301).integers(0, 2**32, size=(COORDINATES, 1), dtype=np.uint64).astype(np.uint32)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
CACHED_WORDS = 500_000


def runs(recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has met in a bucket with probability ``recall``, even if in every run its
    buckets were split ``DEPTH`` times.

    A run's first split keeps the pair together with the threshold's probability, each of the others unless all
    ``BRANCHES`` part it; so the fewer splits, the higher the recall.
    """
    together = NUMERATOR / DENOMINATOR
    met = together * (1 - (1 - together) ** BRANCHES) ** DEPTH
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


class Shingler:
    """Distinct 64-bit hashes of the five-word shingles of texts; a shorter text with words is one shingle."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        for c in _BLANK[1:]:
            if c in text:
                text = text.replace(c, " ")
        words = list(filter(None, text.split(" ")))
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known = self.known
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        k = min(SHINGLE, len(h))
        s = h[: len(h) - k + 1].copy()
        for i in range(1, k):
            s = (s ^ (s >> np.uint64(31))) * _PRIME + h[i : len(h) - k + 1 + i]
        s = (s ^ (s >> np.uint64(29))) * _PRIME
        return np.unique(s ^ (s >> np.uint64(32)))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Min-hash values by coordinate, 32 bits."""
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 4096):
        v = low[None, i : i + 4096] * _SEEDS + _OFFSETS
        v ^= v >> np.uint32(15)
        v *= _SEEDS
        np.minimum(least, v.min(axis=1), out=least)
    return least


_SKETCHED = "doc_id long, node long, n_shingles int, sketch binary"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        sizes, out = [], []
        for text in batch.column("text").to_pylist():
            s = shingler(text)
            sizes.append(len(s))
            out.append(sketch(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "node": batch.column("node"), "n_shingles": pa.array(sizes, pa.int32()), "sketch": pa.array(out, pa.binary())})


_ROWS = "kind int, path long, node long, root long, sketch binary"


def _rows(kind: int, path, node, root, sketches) -> pa.RecordBatch:
    n = len(node)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), pa.nulls(n, pa.int64()) if path is None else pa.array(path), pa.array(node), pa.nulls(n, pa.int64()) if root is None else pa.array(root), pa.nulls(n, pa.binary()) if sketches is None else _packed(sketches)],
        names=["kind", "path", "node", "root", "sketch"],
    )


def _packed(sketches: np.ndarray) -> pa.Array:
    width = sketches.shape[1] * sketches.dtype.itemsize
    offsets = pa.py_buffer(np.arange(0, (len(sketches) + 1) * width, width, dtype=np.int32))
    return pa.Array.from_buffers(pa.binary(), len(sketches), [None, offsets, pa.py_buffer(np.ascontiguousarray(sketches))])


def _unpacked(column: pa.Array, dtype) -> np.ndarray:
    """The rows of a binary column of one width as a matrix."""
    if not len(column):
        return np.zeros((0, COORDINATES), dtype)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(dtype).reshape(len(column), -1) if data.ctypes.data % np.dtype(dtype).itemsize == 0 else np.frombuffer(data.tobytes(), dtype).reshape(len(column), -1)


def _first_paths(n_runs: int):
    coordinates = np.random.default_rng(20240302).permutation(COORDINATES)[:n_runs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = _unpacked(batch.column("sketch"), np.uint32)
            small = full.astype(np.uint16)
            node = batch.column("node").to_numpy()
            for r, c in enumerate(coordinates):
                path = _hash_path(np.full(len(node), r, np.uint64), full[:, c].astype(np.uint64), int(c))
                yield _rows(1, path, node, None, small)

    return run


def _hash_path(path: np.ndarray, value: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    h = (path.astype(np.uint64) + np.asarray(salt).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(1)) * _PRIME
    h = (h ^ (h >> np.uint64(31)) ^ value) * _PRIME
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def _next_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Split large buckets: every set goes on along ``BRANCHES`` coordinates that its path has sampled."""
    for batch in batches:
        path, node = batch.column("path").to_numpy(), batch.column("node").to_numpy()
        small = _unpacked(batch.column("sketch"), np.uint16)
        for b in range(BRANCHES):
            pick = (_hash_path(path.view(np.uint64), np.full(len(path), b, np.uint64), 77).view(np.uint64) >> np.uint64(20)) % np.uint64(COORDINATES)
            value = small[np.arange(len(node)), pick.astype(np.int64)].astype(np.uint64)
            yield _rows(1, _hash_path(path.view(np.uint64), value, pick + np.uint64(64 * b)), node, None, small)


def forest(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix, the smallest member of each row's component."""
    m = len(linked)
    root = np.full(m, -1)
    for i in range(m):
        if root[i] < 0:
            root[i] = i
            frontier = [i]
            while frontier:
                near = np.flatnonzero(linked[frontier].any(axis=0) & (root < 0))
                root[near] = i
                frontier = near.tolist()
    return root


def _compare(node: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate links of a bucket, as a spanning forest."""
    linked = np.zeros((len(node), len(node)), bool)
    for i in range(len(node) - 1):
        linked[i, i + 1 :] = (small[i + 1 :] == small[i]).sum(axis=1) >= AGREE
    if not linked.any():
        return node[:0], node[:0]
    root = forest(linked | linked.T)
    moved = root != np.arange(len(node))
    return node[moved], node[root[moved]]


def _buckets(last: bool):
    """Rows sorted by path: links within small buckets (kind 0), the rows of large ones (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path0, flooded, first, pivot = None, False, None, None  # the bucket that the last batch left open
        nodes, sketches, held = [], [], 0

        def close() -> list[tuple[np.ndarray, np.ndarray]]:
            return [_compare(np.concatenate(nodes), np.concatenate(sketches))] if held > 1 and not flooded else []

        for batch in batches:
            path, node = batch.column("path").to_numpy(), batch.column("node").to_numpy()
            small = _unpacked(batch.column("sketch"), np.uint16)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
            links: list[tuple[np.ndarray, np.ndarray]] = []
            sizes = np.diff(cuts)
            inner = np.arange(len(sizes))[1:-1]
            pairs = inner[sizes[inner] == 2]
            if len(pairs):
                at = cuts[pairs]
                close_by = (small[at] == small[at + 1]).sum(axis=1) >= AGREE
                links.append((node[at[close_by] + 1], node[at[close_by]]))
            for k in [0, *inner[sizes[inner] > 2], *([len(sizes) - 1] if len(sizes) > 1 else [])]:
                a, b = cuts[k], cuts[k + 1]
                if path[a] != path0:
                    links += close()
                    path0, flooded, first, pivot = path[a], False, node[a], small[a].copy()
                    nodes, sketches, held = [], [], 0
                nodes.append(node[a:b])
                sketches.append(small[a:b])
                held += b - a
                if held > BUCKET or flooded:
                    flooded = True
                    all_nodes, all_sketches = np.concatenate(nodes), np.concatenate(sketches)
                    if last:
                        yield _rows(0, None, all_nodes, np.full(len(all_nodes), first), None)
                    else:
                        agree = (all_sketches == pivot).sum(axis=1)
                        alike, on = agree >= AGREE, agree < LEAVE
                        links.append((all_nodes[alike], np.full(int(alike.sum()), first)))
                        if on.any():
                            yield _rows(1, np.full(int(on.sum()), path0), all_nodes[on], None, all_sketches[on])
                    nodes, sketches, held = [], [], 0
            if links:
                yield _rows(0, None, np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links]), None)
        for x, y in close():
            yield _rows(0, None, x, y, None)

    return run


def candidate_links(nodes: DataFrame, n_runs: int) -> DataFrame:
    """``a, b`` links between nodes (``node, sketch``) whose sketches agree, found along chosen paths."""
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.select("node", "sketch").mapInArrow(_first_paths(n_runs), _ROWS)
    found = None
    for depth in range(DEPTH + 1):
        dealt = rows.repartition(n, "path").sortWithinPartitions("path")
        level = stage(dealt.mapInArrow(_buckets(depth == DEPTH), _ROWS), "paths")
        links = level.where("kind = 0").select(F.col("node").alias("a"), F.col("root").alias("b"))
        found = links if found is None else found.union(links)
        rows = level.where("kind = 1")
        if depth == DEPTH or rows.isEmpty():
            return found
        rows = rows.select("path", "node", "sketch").mapInArrow(_next_paths, _ROWS)
    return found


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        sets = [shingler(t).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("component", "node", "copies", "blocks", "own")), pa.array(sets, pa.binary())], names=["component", "node", "copies", "blocks", "own", "shingles"])


def similar(sets: list[np.ndarray], left: np.ndarray | None = None) -> np.ndarray:
    """The symmetric matrix of pairs at or above the threshold; with ``left``, only pairs across it."""
    m = len(sets)
    lengths = np.array([len(s) for s in sets])
    everything = np.concatenate(sets)
    _, inverse, df = np.unique(everything, return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(m), lengths)
    by_shingle = of[np.argsort(inverse, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(df)])
    at = np.concatenate([[0], np.cumsum(lengths)])
    linked = np.zeros((m, m), bool)
    for i in range(m):
        ids = inverse[at[i] : at[i + 1]]
        n = df[ids]
        more = n > 1
        ids, n = ids[more], n[more]
        if not len(ids):
            continue
        ends = np.cumsum(n)
        where = np.repeat(starts[ids] - (ends - n), n) + np.arange(ends[-1])
        common = np.bincount(by_shingle[where], minlength=m)
        linked[i] = common * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (lengths + lengths[i])
    np.fill_diagonal(linked, False)
    if left is not None:
        linked &= left[:, None] != left[None, :]
    return linked


_VERIFIED = "node long, root long, n_texts long, n_docs long"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group: one row per set with a link, with a root to which it is connected and its links' numbers."""
    key, group = None, []

    def close() -> Iterator[pa.RecordBatch]:
        rows = {r[0]: r for r in group}  # a repeated row is one set
        members = [r for r in rows.values() if len(r[3])]
        if len(members) > 1:
            across = key[1] != key[2]
            left = np.array([r[2] == key[1] for r in members]) if across else None
            linked = similar([r[3] for r in members], left)
            some = np.flatnonzero(linked.any(axis=1))
            if len(some):
                root = forest(linked)
                nodes, copies = np.array([r[0] for r in members]), np.array([r[1] for r in members])
                yield pa.RecordBatch.from_pydict({"node": nodes[some], "root": nodes[root[some]], "n_texts": linked[some].sum(axis=1).astype(np.int64), "n_docs": linked[some].astype(np.int64) @ copies})

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("component", "i", "j", "node", "copies", "own", "shingles")]
        for component, i, j, node, copies, own, shingles in zip(*columns, strict=True):
            if (component, i, j) != key:
                yield from close()
                key, group = (component, i, j), []
            group.append((node, copies, own, np.frombuffer(shingles, np.uint64)))
    yield from close()


def _in_blocks(members: DataFrame) -> DataFrame:
    """``component, _node, copies, _rep, blocks, own``: the members of each component dealt into blocks."""
    sizes = members.groupBy("component").agg(F.count("*").alias("sets"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.lit(1)).cast("int")
    members = members.join(sizes.select("component", blocks.alias("blocks")), "component")
    return stage(members.select("component", F.col("node").alias("_node"), "copies", F.col("rep").alias("_rep"), "n_shingles", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")), "members")


def _compared(docs: DataFrame, members: DataFrame, across: bool) -> DataFrame:
    """Exact links within blocks of candidate components, and ``across`` them; a node has a row for each pair of blocks."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = members.drop("n_shingles")
    side = F.broadcast(members) if members.count() <= BROADCAST_ROWS else members
    texts = docs.join(side, F.col("doc_id").eqNullSafe(F.col("_rep")) & (F.col("node") == F.col("_node"))).select("component", "node", "copies", "blocks", "own", "text")
    sets = texts.mapInArrow(_shingled, "component long, node long, copies long, blocks int, own int, shingles binary")
    others = F.sequence(F.lit(0), F.col("blocks") - 1) if across else F.array("own")
    pair = F.explode(F.transform(others, lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j"))))
    grouped = sets.withColumn("p", pair).select("component", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "node", "copies", "own", "shingles")
    return grouped.repartition(n, "component", "i", "j").sortWithinPartitions("component", "i", "j").mapInArrow(_verify, _VERIFIED)


def verified_links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """All exact links within candidate components: ``node, root, n_texts, n_docs``; a node has a row for each block pair.

    ``members`` has ``node, component, copies, rep, n_shingles``; ``docs`` has ``doc_id, node, text``.
    """
    return _compared(docs, _in_blocks(members), True)


def class_links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``node, root``: links that connect what all exact links connect, without comparing all pairs of large components.

    Components of one block are compared whole. Of those of several, each block is compared in itself first, then the
    blocks' classes by one set each; only components that are still in several classes are compared whole, since a link
    between any of their sets could join them. So a large group of near copies costs its sets once, not once a block.
    """
    blocked = _in_blocks(members)
    links = stage(_compared(docs, blocked, False), "verified").select("node", "root")
    large = stage(blocked.where("blocks > 1").withColumnRenamed("_node", "node").withColumnRenamed("_rep", "rep").drop("blocks", "own"), "large")
    if large.isEmpty():
        return links
    roots = large.join(links.distinct(), "node", "left")
    first = roots.where(F.col("root").isNull() | (F.col("root") == F.col("node"))).drop("root")
    links = links.union(stage(_compared(docs, _in_blocks(first), False), "verified").select("node", "root"))
    classes = connected_components(links.join(large.select("node"), "node", "left_semi").select(F.col("node").alias("a"), F.col("root").alias("b")))
    labelled = large.join(classes.select(F.col("id").alias("node"), F.col("component").alias("label")), "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = stage(labelled.groupBy("component").agg(F.min("label").alias("one"), F.max("label").alias("other")).where("one < other").select("component"), "split")
    if split.isEmpty():
        return links
    return links.union(stage(verified_links(docs, large.join(split, "component", "left_semi")), "verified").select("node", "root"))


def near_duplicates(docs: DataFrame, recall: float = RECALL, count_links: bool = True) -> DataFrame:
    """``doc_id, node, component, class_id, n_links, n_text_links, class_size`` for every row of ``docs``.

    ``class_id`` is the smallest doc_id of the connected component of links at Jaccard 0.8 or more over five-word
    shingles; ``n_links`` counts the other rows linked to this one (equal texts included), ``n_text_links`` the other
    texts. ``node`` is a 64-bit hash of the text, ``component`` the smallest of the class. Null counts as the empty text; texts without words are linked to their
    equals only; a text of fewer than five words is one shingle; an empty table gives an empty result; columns other
    than doc_id and text are not read. Without ``count_links`` the numbers of links are null, and large groups are not
    compared whole. Texts are shingled whole, whatever their length.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))
    sketched = stage(rows.select("doc_id", "node", "text").mapInArrow(_sketches, _SKETCHED), "sketches")
    nodes = stage(sketched.groupBy("node").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles")), "texts")
    unique = sketched.where("sketch is not null").select("node", "sketch").dropDuplicates(["node"])
    candidates = connected_components(candidate_links(unique, runs(recall)))
    members = candidates.select(F.col("id").alias("node"), "component").join(nodes, "node")
    if count_links:
        verified = stage(verified_links(rows, members), "verified")
    else:
        verified = class_links(rows, members).withColumns({"n_texts": F.lit(None).cast("long"), "n_docs": F.lit(None).cast("long")})
    links = verified.groupBy("node").agg(F.sum("n_texts").alias("n_text_links"), F.sum("n_docs").alias("n_docs"))
    classes = connected_components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = nodes.join(classes.withColumnRenamed("id", "node"), "node", "left").join(links, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stage(placed, "placed")
    none = F.lit(0) if count_links else F.lit(None).cast("long")
    named = placed.groupBy("component").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"))
    info = placed.join(named, "component").select(
        "node", "component", "class_id", "class_size", (F.col("copies") - 1 + F.coalesce("n_docs", none)).alias("n_links"), F.coalesce("n_text_links", none).alias("n_text_links")
    )
    return sketched.select("doc_id", "node").join(info, "node", "left").select("doc_id", "node", "component", "class_id", "n_links", "n_text_links", "class_size")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, all columns, without the near duplicates of others: of each class one row stays, with the
    smallest doc_id, and of several rows of the class with that id one. Classes may share ids, or have none."""
    no_id = F.lit(-(2**63)).cast("long")
    tagged = packed(docs).withColumns({"_id": F.coalesce(F.col("row.doc_id").cast("long"), no_id), "_node": F.xxhash64(F.coalesce("row.text", F.lit("")))})
    first = near_duplicates(docs, count_links=False, **settings).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = first.groupBy("component").agg(F.coalesce(F.min("doc_id").cast("long"), no_id).alias("_id"), F.min("node").alias("_node")).select("_id", "_node")
    return tagged.join(kept, ["_id", "_node"], "left_semi").dropDuplicates(["_id", "_node"]).select("row.*")
